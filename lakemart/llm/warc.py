"""Deterministic sharded WARC writer and reader (operator 8).

Pages are sorted into ranges by id, and each range (a shard) is written by one
task as a run of files, each record a gzip member of its own.  A file is closed once its
compressed size reaches ``file_bytes``.  The ranges come from exact sums of
payload bytes by id, not from a sample, and files are named by their shard; headers, record
ids and digests are made anew from the page.  So the same table gives the same
files, byte for byte, however it is partitioned and wherever it is written.  A file is
written under a temporary name and renamed when whole; the table of finished
files (the manifest) is written last, and readers open only what it lists.  A
task that is run again writes the same files under the same names.

Which payloads were stored before is decided by a grouped minimum over
digests; only the pages that revisit another get a row of it, and these rows
meet their pages in the sort, so the html is shuffled once.

Files are opened through Arrow's file systems, in the folder the caller names
or the cluster's shared scratch folder.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.components import stored
from lakemart.llm.textblocks import map_batches

FILE_BYTES = 32 << 20
DATE = "2000-01-01T00:00:00Z"
_MANIFEST = "file string, records long, bytes long, first_id long, last_id long, sha256 string"


#: Schemes of Hadoop's file systems by Arrow's names for them.
_SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme and host that Spark resolves it to, in a scheme that Arrow opens."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    scheme, _, rest = full.partition(":")
    if scheme not in _SCHEMES:
        raise ValueError(f"archives can't be written to {scheme}: paths, but to {', '.join(sorted(_SCHEMES))}")
    return f"{_SCHEMES[scheme]}:{rest}"


def _store(uri: str):
    """(Arrow file system, path) of a qualified folder."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


#: Ranges that the ids of a table are cut into at least, so that a small table is written by several tasks too.
LEAST_SHARDS = 32
#: Bytes that a record counts beside its payload.
RECORD_BYTES = 600


@dataclass
class Shards:
    """Which shard a page belongs to: by the ranges of ids; single ids of more than a shard's bytes by their digest too."""

    starts: np.ndarray
    shard: np.ndarray
    heavy: dict[int | None, tuple[int, int]]

    def of(self, ids: pa.Array, digests: pa.Array) -> np.ndarray:
        none = ids.is_null().to_numpy(zero_copy_only=False)
        own = ids.fill_null(0).to_numpy(zero_copy_only=False)
        out = np.zeros(len(own), np.int64)
        if len(self.starts):
            out = self.shard[np.maximum(np.searchsorted(self.starts, own, "right") - 1, 0)].copy()
        for i in np.flatnonzero(none | np.isin(own, [h for h in self.heavy if h is not None])).tolist() if self.heavy else ():
            first, n = self.heavy.get(None if none[i] else int(own[i]), (None, 1))
            if first is not None:
                out[i] = first + (int(digests[i].as_py()[:8], 16) * n >> 32)
        return out


def _edges(lo: int, hi: int, n: int) -> list[int]:
    """Starts of about n equally wide ranges of the ids lo..hi."""
    width = -(-(hi - lo + 1) // max(1, n))
    return list(range(lo, hi + 1, width))


def plan_shards(sizes: DataFrame, shard_bytes: int) -> Shards:
    """Shards of about ``shard_bytes`` from (page_id, bytes), one row for each id.

    Ranges of ids are cut again where they hold more than a shard, down to single
    ids; only the sums of the ranges, whose number follows from the bytes, come to
    the driver.
    """
    total, lo, hi, unnamed = sizes.agg(
        F.sum("bytes"), F.min("page_id"), F.max("page_id"), F.sum(F.when(F.col("page_id").isNull(), F.col("bytes")))).first()
    if total is None:
        return Shards(np.zeros(0, np.int64), np.zeros(0, np.int64), {})
    limit = max(1, min(shard_bytes, -(-total // LEAST_SHARDS)))
    heavy: dict[int | None, tuple[int, int]] = {}
    now, starts, shards = 0, [], []
    if unnamed:
        n = -(-unnamed // limit)
        heavy[None], now = (0, n), n
    if lo is not None:
        edges = _edges(lo, hi, 4 * -(-total // limit))
        while True:
            own = np.array(edges, np.int64)

            def placed(batches, own=own):
                for batch in batches:
                    at = own[np.searchsorted(own, batch.column("page_id").to_numpy(), "right") - 1]
                    yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("bytes")], names=["start", "bytes"])

            done = {r[0]: r[1] for r in sizes.where("page_id IS NOT NULL").mapInArrow(placed, "start long, bytes long")
                    .groupBy("start").agg(F.sum("bytes")).collect()}
            ends = dict(zip(edges, [*edges[1:], hi + 1], strict=True))
            large = [a for a in edges if done.get(a, 0) > limit and ends[a] - a > 1]
            if not large:
                break
            edges = sorted({*edges, *(b for a in large for b in _edges(a, ends[a] - 1, 64))})
        held = 0
        for a in edges:
            size = done.get(a, 0)
            if held and held + size > limit:
                now, held = now + 1, 0
            starts.append(a)
            shards.append(now)
            held += size
            if size > limit:  # one id
                n = -(-size // limit)
                heavy[a], now, held = (now, n), now + n, 0
    return Shards(np.array(starts, np.int64), np.array(shards, np.int64), heavy)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(page_id, url: str | None, payload: bytes, digest: str, revisit: bool, refers_to, ordinal: int) -> bytes:
    """One record as a gzip member."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    body = http if revisit else http + payload
    name = hashlib.sha256(f"{page_id}|{digest}|{ordinal}".encode()).digest()[:16]
    head = [
        "WARC/1.1", "WARC-Type: " + ("revisit" if revisit else "response"),
        f"WARC-Record-ID: <urn:uuid:{uuid.UUID(bytes=name)}>", f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + " ".join((url or "").split()),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}",
        f"WARC-Payload-Digest: sha1:{digest}", "WARC-Block-Digest: sha1:" + base32_sha1(body),
        f"WARC-X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        head.append("WARC-X-Has-URI: 1")
    if page_id is not None:
        head.append(f"WARC-X-Page-ID: {page_id}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers_to is not None:
            head.append(f"WARC-X-Refers-To-Page-ID: {refers_to}")
    data = "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Files:
    """The run of files of one shard."""

    def __init__(self, folder: str, part: int, limit: int):
        self.fs, self.path = _store(folder)
        self.part, self.limit, self.n, self.out, self.rows = part, limit, 0, None, []

    def add(self, page_id, record: bytes) -> None:
        if self.out is None:
            self.name = f"part-{self.part:06d}-{self.n:05d}.warc.gz"
            self.temporary = f"{self.path}/.tmp-{uuid.uuid4().hex}"
            self.out, self.sha = self.fs.open_output_stream(self.temporary, compression=None), hashlib.sha256()
            self.records, self.bytes, self.first = 0, 0, page_id
        self.out.write(record)
        self.sha.update(record)
        self.records, self.bytes, self.last = self.records + 1, self.bytes + len(record), page_id
        if self.bytes >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.temporary, f"{self.path}/{self.name}")
            self.rows.append((self.name, self.records, self.bytes, self.first, self.last, self.sha.hexdigest()))
            self.out, self.n = None, self.n + 1


def _writer(folder: str, limit: int, min_bytes: int):
    def write(batches):
        files, rows, mark, before, ordinal = None, [], None, None, 0
        for batch in batches:
            columns = [batch.column(c) for c in ("shard", "page_id", "url", "payload", "digest", "refers_to", "revisit")]
            for shard, page_id, url, payload, digest, refers_to, revisit in zip(*(c.to_pylist() for c in columns)):
                if files is None or files.part != shard:
                    if files is not None:
                        files.close()
                    files = _Files(folder, shard, limit)
                    rows.append(files.rows)
                    mark, before, ordinal = None, None, 0
                if revisit:  # sorted before its page
                    mark = (page_id, digest, refers_to)
                    continue
                ordinal = ordinal + 1 if before == (page_id, digest) else 0
                before = (page_id, digest)
                code = base64.b32encode(bytes.fromhex(digest)).decode()
                if mark is not None and mark[:2] == before:
                    files.add(page_id, _record(page_id, url, payload, code, True, mark[2], ordinal))
                elif ordinal and len(payload) >= min_bytes:
                    files.add(page_id, _record(page_id, url, payload, code, True, page_id, ordinal))
                else:
                    files.add(page_id, _record(page_id, url, payload, code, False, None, ordinal))
        if files is not None:
            files.close()
        if any(rows):
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("file", "records", "bytes", "first_id", "last_id", "sha256"), r)) for own in rows for r in own],
                schema=pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()),
                                  ("first_id", pa.int64()), ("last_id", pa.int64()), ("sha256", pa.string())]))

    return write


def write_warc(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, min_bytes: int = 0,
               shard_bytes: int | None = None) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html) to ``folder``; returns the manifest.

    A shard has about ``shard_bytes`` bytes of payloads (default: four files),
    or a 32nd of the table if that is less; its number and files depend on the
    table's rows alone.
    Of rows with equal payloads of at least ``min_bytes`` bytes the one with the
    least id is a response and the others are revisits of it; smaller payloads
    are all responses.  Of repeated rows with that id and payload the first is the response.

    Nulls: a null html is an empty payload; a null url is kept as null; a row
    without id sorts first, revisits a row with an id and the same payload, and
    is a response if there is none (the first of those rows; the rest revisit
    nothing by name).  Other columns are left aside.  An empty table gives an
    empty manifest.
    """
    spark = pages.sparkSession
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    own = own.withColumn("digest", F.sha1("payload"))
    store = qualified(spark, folder)
    sizes = stored(own.groupBy("page_id").agg(F.sum(F.octet_length("payload") + F.lit(RECORD_BYTES).cast("long")).alias("bytes")),
                   spark, "warc-sizes")
    shards = spark.sparkContext.broadcast(plan_shards(sizes, shard_bytes or 4 * file_bytes))

    @F.arrow_udf("long")
    def shard(ids: pa.Array, digests: pa.Array) -> pa.Array:
        return pa.array(shards.value.of(ids, digests))

    keys = own.where(F.octet_length("payload") >= min_bytes).select("page_id", "digest")
    twice = (keys.groupBy("digest").agg(F.min("page_id").alias("least"), F.max("page_id").alias("most"),
                                        (F.count("*") > F.count("page_id")).alias("unnamed"))
             .where("least < most OR (unnamed AND least IS NOT NULL)"))
    marks = stored(keys.distinct().join(twice, "digest").where("NOT page_id <=> least")
                   .select("page_id", "digest", F.col("least").alias("refers_to")), spark, "warc-revisits")
    rows = (own.withColumns({"refers_to": F.lit(None).cast("long"), "revisit": F.lit(False)})
            .select("page_id", "url", "payload", "digest", "refers_to", "revisit")
            .unionByName(marks.withColumn("revisit", F.lit(True)), allowMissingColumns=True)
            .withColumn("shard", shard("page_id", "digest"))
            .repartition("shard")
            .sortWithinPartitions("shard", "page_id", "digest", F.desc("revisit"), "url"))
    fs, path = _store(store)
    fs.create_dir(path, recursive=True)
    files = rows.mapInArrow(_writer(store, file_bytes, min_bytes), _MANIFEST)
    files.write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def _members(stream):
    """The uncompressed bytes of each gzip member, one at a time."""
    unpack, parts = zlib.decompressobj(31), []
    while chunk := stream.read(1 << 20):
        while chunk:
            parts.append(unpack.decompress(chunk))
            chunk = b""
            if unpack.eof:
                yield b"".join(parts)
                chunk, unpack, parts = unpack.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("an archive ends within a record")


def _parse(data: bytes) -> dict:
    head, _, body = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    field = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    body = body[:int(field["Content-Length"])]
    if base32_sha1(body) != field["WARC-Block-Digest"].removeprefix("sha1:"):
        raise ValueError("a record's block doesn't match its digest")
    payload = body.partition(b"\r\n\r\n")[2] if field["WARC-Type"] == "response" else None
    digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
    if payload is not None and base32_sha1(payload) != digest:
        raise ValueError("a record's payload doesn't match its digest")
    number = lambda k: int(field[k]) if k in field else None
    return {"page_id": number("WARC-X-Page-ID"), "url": field["WARC-Target-URI"] if "WARC-X-Has-URI" in field else None,
            "payload_bytes": number("WARC-X-Payload-Length") if payload is None else len(payload), "payload_digest": digest,
            "record_type": field["WARC-Type"], "refers_to": number("WARC-X-Refers-To-Page-ID"), "payload": payload}


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the files that the manifest lists; digests are checked on the way."""
    store = qualified(spark, folder)
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
              + (", payload binary" if payloads else ""))

    def read(batch):
        for name in batch.column("file").to_pylist():
            fs, path = _store(store)
            with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                rows = []
                size = 0
                for data in _members(stream):
                    rows.append(_parse(data))
                    size += len(data)
                    if len(rows) == 1000 or size > 16 << 20:
                        yield {c: [r[c] for r in rows] for c in rows[0]}
                        rows, size = [], 0
                if rows:
                    yield {c: [r[c] for r in rows] for c in rows[0]}

    files = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest").select("file")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a stated number is not coalesced by size
    return map_batches(files.repartition(tasks, "file"), read, schema)


def oracle_sql() -> str:
    """DuckDB SQL for ``op8_warc``'s rows: base 32 from five hex digits at a time."""
    return """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
least_ AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substr(h, 1 + 5 * (j // 4), 5) AS BIGINT) >> (15 - 5 * (j % 4))) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN least_ USING (h)"""
