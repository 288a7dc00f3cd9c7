"""Ranked lexical search over a length-stratified index (operator 12).

Documents whose length normaliser m is equal form a stratum.  A stratum is
stored in blocks of bounded size; in a block each term has its postings by
term frequency, so that within it all documents of a run have the same
impact, which is computed once for each frequency.  The largest frequency of
each term bounds what a block's documents can score for a query; a query
visits blocks by falling bound and leaves those whose bound lies below its
k-th best score.

The index has the documents of each stratum, no scores: a query's weights come
from the stored term counts.  Terms are kept as 64-bit hashes.  The
table of terms has each hash with its least and greatest term, so a hash that
a query shares with a second term is noticed, and the index built again with
another hash function.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.llm.components import stored
from lakemart.llm.textblocks import ALNUM_WORD, Block, blocks, map_batches, mix, row_of

#: (document, term) pairs of a block (or one document, if it has more).
BLOCK_PAIRS = 1 << 18
#: Bytes of index blocks that a task of a search orders by their bounds at once.
VISIT_BYTES = 32 << 20
#: (item, term) pairs that are sent to a search's tasks at once.
QUERY_PAIRS = 1 << 20
#: Distinct terms that a task adds up before it passes them on.
TERMS_HELD = 1 << 19
#: Strata whose number of parts is sent to the tasks; each of the others has at most this share of all words and is one part.
SPLIT_STRATA = 1 << 16
#: Below this doubles add the scores exactly.
_EXACT = 1 << 53


def _hashes(block: Block, start: np.ndarray, end: np.ndarray, seed: int, bits: int) -> np.ndarray:
    """A hash for each word of lower-cased bytes; ``seed`` chooses the function."""
    if seed:
        data = block.data.tobytes().lower()  # bytes.lower changes A-Z alone
        h = np.fromiter((xxhash.xxh64_intdigest(data[a:b], seed) for a, b in zip(start.tolist(), end.tolist(), strict=True)),
                        np.uint64, len(start))
    else:
        h = block.span_hash(start, end)
    return (h >> np.uint64(64 - bits)).astype(np.int64) if bits < 64 else h.view(np.int64)


def _others(data: np.ndarray, start: np.ndarray, end: np.ndarray, rep: np.ndarray) -> np.ndarray:
    """The words whose bytes aren't those of the word ``rep`` says."""
    n = end - start
    same = n == n[rep]
    at, n = np.flatnonzero(same), n[same]
    if not len(at):
        return np.flatnonzero(~same)
    first = np.cumsum(n) - n
    pos = np.arange(n.sum()) - np.repeat(first, n)
    differ = data[np.repeat(start[at], n) + pos] != data[np.repeat(start[rep[at]], n) + pos]
    same[at] = ~np.logical_or.reduceat(differ, first)
    return np.flatnonzero(~same)


@dataclass
class _Forward:
    """A block's distinct (row, term) pairs by row and hash, with their counts; words of each row."""

    row: np.ndarray
    h: np.ndarray
    tf: np.ndarray
    n: np.ndarray

    @classmethod
    def of(cls, h: np.ndarray, first: np.ndarray) -> _Forward:
        row = row_of(first)
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(new)
        return cls(row[at], h[at], np.diff(at, append=len(h)), np.diff(first))


_COUNTS = pa.schema([("kind", pa.int8()), ("h", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("cf", pa.int64())])


def _count_block(block: Block, seed: int, bits: int) -> list[pa.Table]:
    start, end, first = block.words(ALNUM_WORD)
    h = _hashes(block, start, end, seed, bits)
    f = _Forward.of(h, first)
    n, docs = np.unique(f.n[f.n > 0], return_counts=True)
    out = [pa.table([np.ones(len(n), np.int8), n, pa.nulls(len(n), pa.string()), docs, n * docs], schema=_COUNTS)]
    if len(h):
        own, at, which, cf = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        df = np.bincount(np.searchsorted(own, f.h), minlength=len(own))
        lower = block.data.tobytes().lower()  # bytes.lower changes A-Z alone
        other = _others(np.frombuffer(lower, np.uint8), start, end, at[which])
        at = np.concatenate([at, other])
        none = np.zeros(len(other), np.int64)
        terms = [lower[a:b].decode("utf-8", "replace") for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)]
        out.append(pa.table([np.zeros(len(at), np.int8), h[at], pa.array(terms, pa.string()),
                             np.concatenate([df, none]), np.concatenate([cf, none])], schema=_COUNTS))
    return out


def _counted(texts: DataFrame, seed: int, bits: int) -> DataFrame:
    """Rows (kind, h, term, df, cf): partial counts of terms (kind 0), and of documents by length h (kind 1)."""
    def run(batches):
        held, rows = [], 0

        def added() -> pa.Table:
            t = pa.concat_tables(held).group_by(["kind", "h", "term"]).aggregate([("df", "sum"), ("cf", "sum")])
            return t.rename_columns(["kind", "h", "term", "df", "cf"]).select(_COUNTS.names).cast(_COUNTS)

        for batch in batches:
            for block in blocks(batch.column("text"), lower=True):
                more = _count_block(block, seed, bits)
                held += more
                rows += sum(t.num_rows for t in more)
                if rows > TERMS_HELD:
                    held = [added()]
                    rows = held[0].num_rows
                    if rows > TERMS_HELD // 2:
                        yield from held[0].to_batches()
                        held, rows = [], 0
        if held:
            yield from added().to_batches()

    return texts.mapInArrow(run, "kind byte, h long, term string, df long, cf long")


def normaliser(n: int, docs: int, words: int) -> int:
    """m of a document of n words."""
    return 100 - 25 + (25 * n * docs) // words


_FORWARD = "m long, part long, doc_id long, tie long, h array<long>, tf array<int>"


def _lists(values: np.ndarray, counts: np.ndarray, dtype) -> pa.ListArray:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(dtype)))


def _forward(texts: DataFrame, docs: int, words: int, split: dict[int, int], seed: int, bits: int) -> DataFrame:
    """A row for each document with a term: its stratum and the part of it, its terms and their counts."""
    sent = texts.sparkSession.sparkContext.broadcast(split)

    def rows(batch):
        for block in blocks(batch.column("text"), lower=True):
            start, end, first = block.words(ALNUM_WORD)
            f = _Forward.of(_hashes(block, start, end, seed, bits), first)
            some = np.flatnonzero(f.n)
            lengths, which = np.unique(f.n[some], return_inverse=True)
            ms = [normaliser(n, docs, words) for n in lengths.tolist()]
            m = np.array(ms, np.int64)[which] if len(ms) else np.zeros(0, np.int64)
            parts = np.array([sent.value.get(x, 1) for x in ms], np.int64)[which] if len(ms) else m
            ids = batch.column("doc_id").slice(block.first_row, block.rows).take(pa.array(some))
            tie = block.span_hash(block.offsets[some], block.offsets[some + 1])
            key = mix(ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ mix(tie))
            counts = np.bincount(f.row, minlength=block.rows)[some]
            yield {"m": m, "part": (key % np.maximum(parts, 1).astype(np.uint64)).astype(np.int64), "doc_id": ids,
                   "tie": tie.view(np.int64), "h": _lists(f.h, counts, np.int64), "tf": _lists(f.tf, counts, np.int32)}

    return map_batches(texts, rows, _FORWARD)


_BLOCKS = pa.schema([("m", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("terms", pa.list_(pa.int64())),
                     ("term_runs", pa.list_(pa.int32())), ("run_tf", pa.list_(pa.int32())), ("run_docs", pa.list_(pa.int32())),
                     ("docs", pa.list_(pa.int32()))])
_BLOCKS_DDL = ("m long, doc_ids array<long>, terms array<long>, term_runs array<int>, run_tf array<int>, "
               "run_docs array<int>, docs array<int>")


def _one(values: np.ndarray, dtype) -> pa.ListArray:
    return _lists(values, np.array([len(values)]), dtype)


def _block_row(m: int, ids: list[pa.Array], counts: list[np.ndarray], h: list[np.ndarray], tf: list[np.ndarray]) -> pa.RecordBatch:
    """Postings of some documents of one stratum: by term, then by term frequency, then by document."""
    ids, counts, h, tf = pa.concat_arrays(ids), np.concatenate(counts), np.concatenate(h), np.concatenate(tf)
    doc = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((doc, tf, h))
    doc, tf, h = doc[order], tf[order], h[order]
    new_term = np.ones(len(h), bool)
    new_term[1:] = h[1:] != h[:-1]
    new_run = new_term.copy()
    new_run[1:] |= tf[1:] != tf[:-1]
    run = np.flatnonzero(new_run)
    term = np.flatnonzero(new_term[run])
    return pa.RecordBatch.from_arrays([
        pa.array([m], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
        _one(h[run][term], np.int64), _one(np.diff(term, append=len(run)), np.int32), _one(tf[run], np.int32),
        _one(np.diff(run, append=len(h)), np.int32), _one(doc, np.int32)], schema=_BLOCKS)


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _stratum_blocks(forward: DataFrame, block_pairs: int) -> DataFrame:
    """The index's blocks, from rows that come by stratum and part; a block is closed when it is full."""
    def run(batches):
        key, size, held = None, 0, []

        def closed():
            return _block_row(key[0], *map(list, zip(*held, strict=True)))

        for batch in batches:
            if not batch.num_rows:
                continue
            m, part = (batch.column(c).to_numpy() for c in ("m", "part"))
            ids, counts = batch.column("doc_id"), batch.column("h").value_lengths().to_numpy()
            h, tf = _flat(batch.column("h")), _flat(batch.column("tf"))
            upto = np.concatenate([[0], np.cumsum(counts)])
            at = 0
            while at < len(m):
                now = (int(m[at]), int(part[at]))
                if held and (now != key or size + counts[at] > block_pairs):
                    yield closed()
                    held, size = [], 0
                key = now
                end = at + int(np.argmax(np.append((m[at:] != now[0]) | (part[at:] != now[1]), True)))
                full = int(np.searchsorted(upto, upto[at] + block_pairs - size, "right")) - 1
                end = min(end, max(full, at + 1))
                held.append((ids.slice(at, end - at), counts[at:end], h[upto[at]:upto[end]], tf[upto[at]:upto[end]]))
                size += int(upto[end] - upto[at])
                at = end
        if held:
            yield closed()

    dealt = forward.repartition("m", "part").sortWithinPartitions("m", "part", "doc_id", "tie")
    return dealt.mapInArrow(run, _BLOCKS_DDL)


@dataclass
class Index:
    """``blocks``: the strata's postings; ``terms``: (h, term, other, df, cf), ``other`` is another term of that hash or null."""

    blocks: DataFrame
    terms: DataFrame
    docs: int
    words: int
    seed: int
    bits: int
    source: DataFrame
    block_pairs: int


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 0, bits: int = 64,
                block_pairs: int = BLOCK_PAIRS) -> Index:
    """Index all rows of ``docs``; both tables lie in the shared scratch folder.

    Null and empty texts have no terms and aren't in the index.  A row without
    id is a document too; repeated rows are documents of their own.  Texts are
    whole; further columns are left aside; an empty table gives an empty index.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = stored(_counted(texts.select("text"), seed, bits).groupBy("kind", "h", "term")
                     .agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")), spark, "terms")
    lengths = counted.where("kind = 1")
    n_docs, n_words = (int(x or 0) for x in lengths.agg(F.sum(F.col("df").cast("decimal(38,0)")), F.sum(F.col("cf").cast("decimal(38,0)"))).first())
    terms = (counted.where("kind = 0").groupBy("h").agg(
        F.min("term").alias("term"), F.max("term").alias("other"), F.sum("df").alias("df"), F.sum("cf").alias("cf"))
        .withColumn("other", F.expr("nullif(other, term)")))
    split = {}
    if n_docs:
        of = F.expr(f"75 + (25 * cast(h as decimal(20,0)) * {n_docs}) div {n_words}")
        large = (lengths.groupBy(of.alias("m")).agg(F.sum("cf").alias("words")).where(F.col("words") > block_pairs)
                 .orderBy(F.desc("words"), "m").limit(SPLIT_STRATA))
        split = {int(m): -(-int(words) // block_pairs) for m, words in large.collect()}
    built = stored(_stratum_blocks(_forward(texts, n_docs, n_words, split, seed, bits), block_pairs), spark, "strata") if n_docs \
        else spark.createDataFrame([], _BLOCKS_DDL)
    return Index(built, terms, n_docs, n_words, seed, bits, docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), block_pairs)


def weight(df: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


@dataclass
class _Queries:
    """Some items' terms: for each item a run of (term, count), terms by their place in ``h`` (sorted)."""

    items: list
    first: np.ndarray
    term: np.ndarray
    count: np.ndarray
    h: np.ndarray
    weights: np.ndarray


class _Block:
    """A row of the index with what the queries' terms have in it."""

    def __init__(self, row: dict[str, np.ndarray], m: int, ids: pa.Array, q: _Queries):
        self.ids = ids
        terms = row["terms"]
        place = np.minimum(np.searchsorted(terms, q.h), len(terms) - 1)
        hit = np.flatnonzero(terms[place] == q.h)
        place = place[hit]
        runs = np.concatenate([[0], np.cumsum(row["term_runs"])])
        upto = np.concatenate([[0], np.cumsum(row["run_docs"], dtype=np.int64)])
        tfs, of = np.unique(row["run_tf"], return_inverse=True)
        tfs = tfs.astype(np.int64)
        impact = ((1_000_000_000 * tfs) // (1000 * tfs + 12 * m))[of]  # once for each frequency
        self.postings = {}
        ceiling = np.zeros(len(q.h), np.int64)
        ceiling[hit] = q.weights[hit] * impact[runs[place + 1] - 1]  # the last run has the largest frequency
        for t, a, b in zip(hit.tolist(), runs[place].tolist(), runs[place + 1].tolist(), strict=True):
            self.postings[t] = (row["docs"][upto[a]:upto[b]], np.repeat(impact[a:b], row["run_docs"][a:b]))
        self.bounds = np.add.reduceat(ceiling[q.term] * q.count, q.first[:-1]) if len(q.term) else np.zeros(len(q.items), np.int64)

    @property
    def nbytes(self) -> int:
        return self.ids.nbytes + self.bounds.nbytes + sum(d.nbytes + v.nbytes for d, v in self.postings.values())

    def scores(self, q: _Queries, item: int) -> np.ndarray:
        docs, values = [], []
        for i in range(q.first[item], q.first[item + 1]):
            got = self.postings.get(int(q.term[i]))
            if got is not None:
                docs.append(got[0])
                values.append(got[1] * (q.weights[q.term[i]] * q.count[i]))
        docs, values = np.concatenate(docs), np.concatenate(values)
        if self.bounds[item] < _EXACT:
            return np.bincount(docs, values, len(self.ids)).astype(np.int64)
        out = np.zeros(len(self.ids), np.int64)
        np.add.at(out, docs, values)
        return out


class _Best:
    """The k best documents of an item so far: higher scores first, equal ones by id, those without id last."""

    def __init__(self, k: int):
        self.k, self.score, self.none, self.ids = k, np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def least(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: pa.Array) -> None:
        at = np.flatnonzero(score >= self.least())
        if not len(at):
            return
        got = ids.take(pa.array(at))
        score = np.concatenate([self.score, score[at]])
        none = np.concatenate([self.none, got.is_null().to_numpy(zero_copy_only=False)])
        ids = np.concatenate([self.ids, got.fill_null(0).to_numpy(zero_copy_only=False)])
        order = np.lexsort((ids, none, -score))[:self.k]
        self.score, self.none, self.ids = score[order], none[order], ids[order]


_FOUND = "item int, item_id long, doc_id long, score long"


def _searched(index: DataFrame, q: _Queries, k: int, visit_bytes: int) -> DataFrame:
    """Each task's k best documents of each item."""
    sent = index.sparkSession.sparkContext.broadcast(q)

    def run(batches):
        q, best, held, size = sent.value, {}, [], 0

        def visit():
            bounds = np.stack([b.bounds for b in held])
            for item in np.flatnonzero(bounds.max(0) > 0).tolist():
                mine = best.setdefault(item, _Best(k))
                for at in np.argsort(-bounds[:, item], kind="stable").tolist():
                    if bounds[at, item] < mine.least():
                        break  # nor do the blocks after it reach the k-th best
                    mine.add(held[at].scores(q, item), held[at].ids)

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                parts = {c: _flat(row.column(c)) for c in ("terms", "term_runs", "run_tf", "run_docs", "docs")}
                held.append(_Block(parts, row.column("m")[0].as_py(), row.column("doc_ids").flatten(), q))
                size += held[-1].nbytes
                if size > visit_bytes:
                    visit()
                    held, size = [], 0
        if held:
            visit()
        rows = [(i, b) for i, b in sorted(best.items()) if len(b.score)]
        for at in range(0, len(rows), 4096):
            some = rows[at:at + 4096]
            n = [len(b.score) for _, b in some]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat([i for i, _ in some], n), pa.int32()),
                pa.array([q.items[i] for i, b in some for _ in b.score], pa.int64()),
                pa.array(np.concatenate([b.ids for _, b in some]), mask=np.concatenate([b.none for _, b in some])),
                pa.array(np.concatenate([b.score for _, b in some]))], names=["item", "item_id", "doc_id", "score"])

    return index.mapInArrow(run, _FOUND)


def _item_terms(items: DataFrame, seed: int, bits: int) -> DataFrame:
    """(item_id, part key, h, term, n): the distinct terms of each item row."""
    def rows(batch):
        for block in blocks(batch.column("text"), lower=True):
            start, end, first = block.words(ALNUM_WORD)
            h, row = _hashes(block, start, end, seed, bits), row_of(first)
            lower = block.data.tobytes().lower()
            seen: dict[tuple[int, str], list[int]] = {}
            for r, x, a, b in zip(row.tolist(), h.tolist(), start.tolist(), end.tolist(), strict=True):
                seen.setdefault((r, lower[a:b].decode("utf-8", "replace")), [x, 0])[1] += 1
            of = pa.array([block.first_row + r for r, _ in seen], pa.int64())
            yield {"item_id": batch.column("item_id").take(of), "key": batch.column("key").take(of), "h": [x for x, _ in seen.values()],
                   "term": [t for _, t in seen], "n": [n for _, n in seen.values()]}

    return map_batches(items, rows, "item_id long, key long, h long, term string, n long")


class _Shared(Exception):
    """A query's term has the hash of another term."""


def _queries(terms: DataFrame, index: Index, part: int, parts: int) -> _Queries:
    """The items of one part of the queries, with their terms' weights."""
    own = terms.where(F.expr(f"pmod(hash(item_id, key), {parts})") == part)
    known = index.terms.select(F.col("h").alias("of"), F.col("term").alias("first"), "other", "df")
    got = own.join(known, F.col("h") == F.col("of")).select("item_id", "key", "h", "term", "n", "first", "other", "df").toArrow().to_pylist()
    if any(r["other"] is not None or r["first"] != r["term"] for r in got):
        raise _Shared
    got.sort(key=lambda r: (r["item_id"] is not None, r["item_id"] or 0, r["key"]))
    df = {r["h"]: r["df"] for r in got}
    h = np.array(sorted(df), np.int64)
    place = {x: i for i, x in enumerate(h.tolist())}
    items, first, of = [], [], []
    for i, (key, rows) in enumerate(itertools.groupby(got, lambda r: (r["item_id"], r["key"]))):
        rows = list(rows)
        items.append(key[0])
        first.append(len(of))
        of += [(place[r["h"]], r["n"]) for r in rows]
    pairs = np.array(of, np.int64).reshape(-1, 2)
    return _Queries(items, np.array([*first, len(of)]), pairs[:, 0], pairs[:, 1], h,
                    np.array([weight(df[x], index.docs) for x in h.tolist()], np.int64))


def search(index: Index, items: DataFrame, k: int = 20, item_col: str = "item_id", text_col: str = "text",
           query_pairs: int = QUERY_PAIRS, visit_bytes: int = VISIT_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item with a score above 0, or all if fewer.

    Equal scores go by ascending doc_id, documents without id behind those with
    one.  Repeated rows of ``items`` count once; an id with several texts has a
    ranking for each text.  A null item text or one without known terms gives
    no rows, and so does an empty index.

    Items are sent to the tasks in parts of about ``query_pairs`` (item, term) pairs;
    each part reads the index once and is written before the next.
    """
    spark: SparkSession = items.sparkSession
    texts = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.where("text IS NOT NULL").distinct().withColumn("key", F.xxhash64("text", F.reverse("text")))
    out = None
    while True:
        terms = stored(_item_terms(texts, index.seed, index.bits), spark, "queries")
        parts = -(-terms.count() // query_pairs) or 1
        try:
            done = []
            for part in range(parts):
                found = _searched(index.blocks, _queries(terms, index, part, parts), k, visit_bytes)
                order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
                found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
                done.append(stored(found, spark, "found") if parts > 1 else found)
        except _Shared:
            # another hash function, over all bits
            index = build_index(index.source, seed=index.seed + 1, block_pairs=index.block_pairs)
            continue
        out = done[0]
        for more in done[1:]:
            out = out.unionAll(more)
        return out


def oracle_sql(k: int = 20) -> str:
    """DuckDB SQL for ``op12_lexical_search``'s rows."""
    words = (r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))")
    return f"""
WITH rows_ AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
tf AS MATERIALIZED (SELECT r, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM (SELECT r, doc_id, {words} AS term FROM rows_) GROUP BY r, term),
n AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
all_ AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM n),
m AS (SELECT r, 100 - 25 + (25 * n * docs) // words AS m FROM n, all_),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), all_),
q AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, {words} AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT item_id, tf.r, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
    FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m ON m.r = tf.r GROUP BY item_id, tf.r, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {k}"""
