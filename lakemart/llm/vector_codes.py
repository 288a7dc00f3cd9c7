"""Product-quantiser codes for vectors, with Drake-Hamerly adaptive bounds (operator 13).

A vector is cut into parts and each part gets the index of the nearest entry
of its position's codebook.  Between the rounds every part keeps its entry,
its b next closest entries with ordered lower bounds on their distances, and
one outer bound for all further entries.  When the codebooks have moved, the
bounds move by as much as the entries did; where all of them still lie above
the distance to the own entry, nothing is computed.  Otherwise the listed
entries whose bounds don't are compared in integers, and only where the outer
bound doesn't hold either is the whole codebook.  b shrinks to what a round
has used.

All distances that decide are exact: components are integers, bounds are
rounded to the safe side, and a bound that is not clearly above counts as
uncertain.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.components import removed, stored_at

#: Entries that a part keeps at first, and at least.
CLOSEST, FEWEST = 16, 2
#: Of the comparisons of a round, the share that may need more listed entries than the next round keeps.
BEYOND = 1 / 64
_CHUNK = 1 << 22


def _floor32(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def _root_up(d: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(d.astype(np.float64)), np.inf)


def _largest(*arrays: np.ndarray) -> int:
    return max((int(np.abs(a).max()) for a in arrays if a.size), default=0)


def _check_range(dims: int, most: int) -> bool:
    """Whether doubles hold the squared distances exactly; an error if 64-bit integers don't."""
    if 4 * dims * most * most >= 1 << 63:
        raise ValueError(f"a component of {most} is too large for squared distances in 64 bits")
    return 4 * dims * most * most < 1 << 53


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all entries, exact."""
    if _check_range(x.shape[1], _largest(x, entries)):
        xf, ef = x.astype(np.float64), entries.astype(np.float64)
        d = (xf * xf).sum(1)[:, None] - 2 * (xf @ ef.T) + (ef * ef).sum(1)
        return d.astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in entries], axis=1)


@dataclass
class Bounds:
    """For some vectors' parts: own entry, next closest entries, their lower bounds, outer bound."""

    own: np.ndarray
    closest: np.ndarray
    low: np.ndarray
    outer: np.ndarray

    @classmethod
    def of(cls, d: np.ndarray, b: int) -> Bounds:
        """From all distances; equal ones go by index."""
        order = np.argsort(d, axis=1, kind="stable")
        low = _floor32(np.sqrt(np.take_along_axis(d, order[:, 1:b + 2], 1).astype(np.float64)))
        outer = low[:, b] if low.shape[1] > b else np.full(len(d), np.inf, np.float32)
        return cls(order[:, 0], order[:, 1:b + 1], low[:, :b], outer)

    def moved(self, drift: np.ndarray, b: int) -> Bounds:
        """After the entries have moved by ``drift``; cut to b entries."""
        low = _floor32(self.low.astype(np.float64) - drift[self.closest])
        outer = _floor32(self.outer.astype(np.float64) - drift.max(initial=0.0))
        low = np.minimum.accumulate(np.concatenate([low, outer[:, None]], 1)[:, ::-1], axis=1)[:, ::-1]
        b = min(b, self.low.shape[1])
        return Bounds(self.own, self.closest[:, :b], low[:, :b], low[:, b])


def assign(x: np.ndarray, entries: np.ndarray, bounds: Bounds) -> tuple[Bounds, np.ndarray, np.ndarray]:
    """(new bounds, squared distance to the own entry, listed entries that were needed; b + 1: all).

    ``bounds`` hold for ``entries``.  The own entry is the nearest, of equally near ones the first.
    """
    n, b = bounds.closest.shape
    _check_range(x.shape[1], _largest(x, entries))
    own, closest, low, outer = (a.copy() for a in (bounds.own, bounds.closest, bounds.low, bounds.outer))
    dist = ((x - entries[own]) ** 2).sum(1)
    reach = _root_up(dist)
    need = (low <= reach[:, None]).sum(1)  # low is ascending
    need[outer <= reach] = b + 1
    step = max(1, _CHUNK // max(1, (b + 1) * max(1, x.shape[1])))
    some = np.flatnonzero((need > 0) & (need <= b))
    for at in range(0, len(some), step):
        rows = some[at:at + step]
        w = int(need[rows].max())
        ids = np.concatenate([own[rows, None], closest[rows]], 1)
        d = np.full(ids.shape, np.iinfo(np.int64).max)
        d[:, 0] = dist[rows]
        seen = np.arange(w) < need[rows, None]
        d[:, 1:w + 1] = np.where(seen, ((x[rows, None, :] - entries[closest[rows, :w]]) ** 2).sum(2), d[:, 1:w + 1])
        least = d.min(1)
        first = np.where(d == least[:, None], ids, len(entries)).min(1)
        known = np.zeros(ids.shape, bool)
        known[:, 0] = True
        known[:, 1:w + 1] = seen
        bound = np.concatenate([low[rows, :1], low[rows]], 1)
        bound[known] = _floor32(np.sqrt(d[known].astype(np.float64)))
        bound[ids == first[:, None]] = -np.inf
        order = np.argsort(bound, axis=1, kind="stable")[:, 1:]
        own[rows], dist[rows] = first, least
        closest[rows], low[rows] = np.take_along_axis(ids, order, 1), np.take_along_axis(bound, order, 1)
    every = np.flatnonzero(need > b)
    step = max(1, _CHUNK // max(1, len(entries)))
    for at in range(0, len(every), step):
        rows = every[at:at + step]
        d = distances(x[rows], entries)
        new = Bounds.of(d, b)
        own[rows], closest[rows], low[rows], outer[rows] = new.own, new.closest, new.low, new.outer
        dist[rows] = np.take_along_axis(d, new.own[:, None], 1)[:, 0]
    return Bounds(own, closest, low, outer), dist, need


def drifts(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """How far each entry has moved, rounded up."""
    _check_range(before.shape[1], _largest(before, after))
    return _root_up(((after - before) ** 2).sum(1))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column without nulls."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != len(column) * dims or (len(column) and not (np.diff(column.offsets.to_numpy()) == dims).all()):
        raise ValueError(f"every vector must have {dims} components, like the first ones")
    return flat.reshape(len(column), dims)


def _bytes(array: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    data = np.ascontiguousarray(array).reshape(len(array), -1)
    width = data.shape[1] * data.itemsize
    offsets = pa.py_buffer(np.arange(len(data) + 1, dtype=np.int32) * np.int32(width))
    return pa.Array.from_buffers(pa.binary(), len(data), [None, offsets, pa.py_buffer(data.tobytes())])


def _from_bytes(column: pa.Array, dtype, shape: tuple[int, ...]) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), *shape)


def _ints(column: pa.Array, dims: int) -> np.ndarray:
    """floor(1024 * x) of each component; such products and their floors are exact in doubles."""
    values = np.floor(1024.0 * _matrix(column, dims).astype(np.float64))
    if values.size and np.abs(values).max() >= 1 << 31:
        raise ValueError("a component is too large for 32-bit integers after its scaling")
    return values.astype(np.int64)


_STATE = "vec_id long, label {label}, v array<int>, own binary, closest binary, low binary, outer binary, used binary"
_FINAL = "vec_id long, label {label}, code binary, error long"


def _mapped(df: DataFrame, fn, ddl: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                cols = fn(batch)
                yield pa.RecordBatch.from_arrays([c if isinstance(c := cols[f.name], pa.Array) else pa.array(c, f.type)
                                                  for f in schema], schema=schema)

    return df.mapInArrow(run, ddl)


def _assigned(df: DataFrame, books: np.ndarray, b: int, label: str, moves: np.ndarray | None, width: int, final: bool) -> DataFrame:
    """Rows with their parts assigned to ``books``; from the vectors if ``moves`` is None, else from the round before."""
    parts, k, d = books.shape
    sent = df.sparkSession.sparkContext.broadcast((books, moves))

    def run(batch):
        books, moves = sent.value
        raw = batch.column("v")
        x = _ints(raw, parts * d) if moves is None else _matrix(raw, parts * d).astype(np.int64)
        n = len(x)
        if moves is not None:
            own = _from_bytes(batch.column("own"), np.uint8, (parts,))
            closest = _from_bytes(batch.column("closest"), np.uint8, (parts, width))
            low = _from_bytes(batch.column("low"), "<f4", (parts, width))
            outer = _from_bytes(batch.column("outer"), "<f4", (parts,))
        out, error = [], np.zeros(n, np.int64)
        for p in range(parts):
            xp = x[:, p * d:(p + 1) * d]
            if moves is None:
                dist = distances(xp, books[p])
                now, used = Bounds.of(dist, b), np.zeros(n, np.int64)
            else:
                old = Bounds(own[:, p].astype(np.int64), closest[:, p].astype(np.int64), low[:, p], outer[:, p])
                now, dist, used = assign(xp, books[p], old.moved(moves[p], b))
                error += dist
            out.append((now.own, now.closest, now.low, now.outer, used))
        own, closest, low, outer, used = (np.stack(a, axis=1) for a in zip(*out, strict=True))
        cols = {"vec_id": batch.column("vec_id"), "label": batch.column("label")}
        if final:
            return cols | {"code": _bytes(own.astype(np.uint8)), "error": error}
        v = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(parts * d)), pa.array(x.reshape(-1).astype(np.int32)))
        return cols | {"v": v, "own": _bytes(own.astype(np.uint8)), "closest": _bytes(closest.astype(np.uint8)),
                       "low": _bytes(low.astype("<f4")), "outer": _bytes(outer.astype("<f4")), "used": _bytes(used.astype("<u2"))}

    return _mapped(df, run, (_FINAL if final else _STATE).format(label=label))


def _sums(state: DataFrame, parts: int, k: int, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sums by part and entry, counts, how often so many listed entries were used).

    Each task adds up its rows first; at most parts * k * (d + 1) numbers and
    k + 1 counts of use come from a task, and as many reach the driver.
    """
    def run(batches):
        total, used = np.zeros((parts, k, d + 1), np.int64), np.zeros(k + 2, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("v"), parts * d).astype(np.int64)
            own = _from_bytes(batch.column("own"), np.uint8, (parts,))
            used += np.bincount(_from_bytes(batch.column("used"), "<u2", (parts,)).reshape(-1), minlength=k + 2)
            for p in range(parts):
                order = np.argsort(own[:, p], kind="stable")
                entry, first = np.unique(own[order, p], return_index=True)
                ones = np.ones((len(x), 1), np.int64)
                total[p, entry] += np.add.reduceat(np.concatenate([x[order, p * d:(p + 1) * d], ones], 1), first, axis=0)
        p, e = np.nonzero(total[:, :, d])
        u = np.flatnonzero(used)
        yield pa.RecordBatch.from_pydict({
            "part": [*p.tolist(), *[-1] * len(u)], "entry": [*e.tolist(), *u.tolist()],
            "sums": [*total[p, e].tolist(), *used[u, None].tolist()]},
            pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("sums", pa.list_(pa.int64()))]))

    rows = (state.select("v", "own", "used").mapInArrow(run, "part int, entry int, sums array<long>")
            .select("part", "entry", F.posexplode("sums").alias("pos", "x"))
            .groupBy("part", "entry", "pos").agg(F.sum("x").alias("x")).toArrow())
    part, entry, pos, x = (rows.column(c).to_numpy() for c in ("part", "entry", "pos", "x"))
    total, used = np.zeros((parts, k, d + 1), np.int64), np.zeros(k + 2, np.int64)
    own = part >= 0
    total[part[own], entry[own], pos[own]] = x[own]
    used[entry[~own]] = x[~own]
    return total[:, :, :d], total[:, :, d], used


def next_width(used: np.ndarray, b: int) -> int:
    """The b of the next round: few of the comparisons by list would have needed more entries."""
    listed = used[1:b + 1]
    if not listed.sum():
        return b
    beyond = listed[::-1].cumsum()[::-1]  # comparisons that used this many or more
    return max(min(FEWEST, b), int((beyond > BEYOND * listed.sum()).sum()))


@dataclass
class Codes:
    """Codebooks (parts, entries, components), the b of each round, and a table (vec_id, label, code, error)."""

    books: np.ndarray
    widths: list[int]
    rows: DataFrame

    def books_sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.reshape(-1).tolist())).encode()).hexdigest()


def encode_vectors(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, closest: int = CLOSEST,
                   id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> Codes:
    """Codes of all rows of ``vectors`` whose vector has no null and no non-finite component.

    ``entries``: at most 256; the codebooks start as the parts of that many
    smallest ids (of a repeated id, its least vector).  Each of ``rounds``
    rounds assigns and moves the entries; then all parts are assigned again.
    Repeated rows count each.  A row without id is coded, but starts no entry.
    Components must fit 32 bits after scaling by 1024, and all vectors must
    have one length that ``parts`` divides; else an error is raised.  Fewer rows
    than entries make smaller codebooks; an empty table gives no rows.

    Each round is written to the shared scratch folder and the one before it
    removed, so a lost executor costs the tasks of one round.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    spark: SparkSession = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where(v.isNotNull() & fine).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    label = kept.schema["label"].dataType.simpleString()
    ids = [r[0] for r in kept.where("vec_id IS NOT NULL").select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()]
    first = [r[0] for r in kept.where(F.col("vec_id").isin(ids)).groupBy("vec_id")
             .agg(F.min(F.col("v").cast("array<double>")).alias("v")).orderBy("vec_id").select("v").collect()]
    if not first:
        some = kept.limit(1).collect()
        first = [r.v for r in some]  # rows without any id
    dims = len(first[0]) if first else 0
    if dims % parts:
        raise ValueError(f"vectors of {dims} components can't be cut into {parts} equal parts")
    d = dims // parts
    start = _ints(pa.array(first, pa.list_(pa.float64())), dims) if first else np.zeros((0, 0), np.int64)
    books = np.ascontiguousarray(start.reshape(len(first), parts, d).transpose(1, 0, 2))
    k = len(first)
    b = min(closest, max(0, k - 1))
    widths = [b]
    if not k:
        return Codes(books, widths, spark.createDataFrame([], _FINAL.format(label=label)))
    path, state = stored_at(_assigned(kept, books, b, label, None, 0, False), spark, "codes")
    for i in range(rounds):
        sums, n, used = _sums(state, parts, k, d)
        moved = np.where(n[:, :, None] > 0, sums // np.maximum(n, 1)[:, :, None], books)
        moves = np.stack([drifts(books[p], moved[p]) for p in range(parts)])
        books, width = moved, widths[-1]
        widths.append(next_width(used, width) if i else width)
        old, last = path, i == rounds - 1
        path, state = stored_at(_assigned(state, books, widths[-1], label, moves, width, last), spark, "codes")
        removed(spark, old)
    if not rounds:
        state = _assigned(state, books, b, label, np.zeros((parts, k)), b, True)
    return Codes(books, widths, state)


def with_label_error(rows: DataFrame) -> DataFrame:
    """``rows`` with the sum of ``error`` over equal labels (nulls together): sums by label, joined back."""
    sums = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return rows.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def oracle_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """DuckDB SQL for ``op13_vector_codes``'s rows."""
    steps = [f"""
kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, embedding FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT r, ((i - 1) * {parts}) // n AS p, (i - 1) % (n // {parts}) AS i, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS x
    FROM (SELECT r, len(embedding) AS n, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM kept)),
c0 AS MATERIALIZED (SELECT p, r - 1 AS e, i, x FROM x WHERE r <= {entries})"""]
    for t in range(rounds + 1):
        steps.append(f"""
a{t} AS MATERIALIZED (SELECT r, p, min(d * {entries} + e) % {entries} AS e, min(d) AS d FROM
    (SELECT r, x.p, e, CAST(sum((x.x - c.x) * (x.x - c.x)) AS BIGINT) AS d FROM x JOIN c{t} c ON x.p = c.p AND x.i = c.i GROUP BY r, x.p, e)
    GROUP BY r, p)""")
        if t < rounds:
            steps.append(f"""
c{t + 1} AS MATERIALIZED (SELECT c.p, c.e, c.i, CAST(coalesce((s - ((s % n) + n) % n) // n, c.x) AS BIGINT) AS x FROM c{t} c LEFT JOIN
    (SELECT a.p, a.e, x.i, sum(x.x) AS s, count(*) AS n FROM a{t} a JOIN x ON a.r = x.r AND a.p = x.p GROUP BY ALL) m
    ON c.p = m.p AND c.e = m.e AND c.i = m.i)""")
    return f"""WITH {",".join(steps)}
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) FROM c{rounds}) AS codebooks_sha256
FROM kept JOIN (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r) USING (r)"""
