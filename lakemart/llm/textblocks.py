"""Vectorised word, line and shingle hashing over Arrow string columns.

An Arrow string column holds all its rows' UTF-8 bytes in one buffer.  The
functions here work on such a buffer in blocks of half a MB: words and lines
are found with byte tables, and every word's 64-bit hash comes from one
running polynomial sum over the block, so no Python object is made per word.

Hashes are 64 bits; equal text always gives equal hashes in every process.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

U = np.uint64
BLOCK_BYTES = 1 << 19
#: Bytes of a batch that map_batches hands on at once (or one row, if that is longer).
SLICE_BYTES = 4 << 20

_BASE = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {"up": np.ones(1, U), "down": np.ones(1, U)}

#: Bytes of words split at white space: all but space and \t \n \v \f \r.
SPACE_WORD = np.ones(256, bool)
SPACE_WORD[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words made of ASCII letters, digits and everything beyond ASCII.
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection with full avalanche)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_RAW = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))
_LOWER = _RAW.copy()
_LOWER[0x41:0x5B] = _RAW[0x61:0x7B]


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        steps = np.full(size, _BASE if kind == "up" else _INVERSE, U)
        steps[0] = U(1)
        have = _powers[kind] = np.multiply.accumulate(steps)
    return have[:n]


class Block:
    """Some rows of a string column: bytes, row offsets, and hashes of spans."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first_row: int, lower: bool):
        self.data, self.offsets, self.first_row = data, offsets, first_row
        self.rows = len(offsets) - 1
        table = _LOWER if lower else _RAW
        terms = table[data] * _power("up", len(data))
        self._sums = np.zeros(len(data) + 1, U)
        np.cumsum(terms, out=self._sums[1:])

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes start..end (end exclusive) of each span."""
        down = _power("down", len(self.data) + 1)
        return mix((self._sums[end] - self._sums[start]) * down[start] + (end - start).astype(U))

    def words(self, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every word, and the index of each row's first word (rows + 1 values)."""
        inside = is_word[self.data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        cuts = self.offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(self.data))]
        begins[cuts] = inside[cuts]
        ends[cuts - 1] = inside[cuts - 1]
        start = np.flatnonzero(begins)
        return start, np.flatnonzero(ends) + 1, np.searchsorted(start, self.offsets)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every line (text between \\n), and each row's first line (rows + 1 values)."""
        breaks = np.flatnonzero(self.data == 0x0A)
        # by row first: a break that ends a row starts an empty last line where the next row starts
        row = np.concatenate([np.arange(self.rows), np.searchsorted(self.offsets, breaks, "right") - 1])
        order = np.lexsort((np.concatenate([self.offsets[:-1], breaks + 1]), row))
        start = np.concatenate([self.offsets[:-1], breaks + 1])[order]
        row = row[order]
        first = np.searchsorted(row, np.arange(self.rows + 1))
        end = np.empty(len(start), np.int64)
        end[:-1] = start[1:] - 1
        end[first[1:] - 1] = self.offsets[1:]
        return start, end, first


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of each item, from the rows' first items."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def shingles(word_hash: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of k words from each word on, and whether these k words lie in one row."""
    n = len(word_hash)
    out = np.zeros(n, U)
    for j in range(min(k, n)):
        out[: n - j] += mix(word_hash[j:] + U((j + 1) * int(_BASE) & (1 << 64) - 1))
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    return mix(out), left >= k


def blocks(column: pa.Array | pa.ChunkedArray, lower: bool = False) -> Iterator[Block]:
    """Blocks of whole rows (nulls count as empty texts) of at most BLOCK_BYTES, or one longer row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, buf = column.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        upto = int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, "right")) - 1
        upto = min(max(upto, row + 1), len(column))
        lo, hi = offsets[row], offsets[upto]
        yield Block(data[lo:hi], offsets[row:upto + 1] - lo, row, lower)
        row = upto


def packed(docs: DataFrame, text_col: str, **more) -> DataFrame:
    """The rows of ``docs`` as one struct column ``row`` (its text a string), beside the columns ``more``.

    So no column of ``docs`` can clash with an operator's own.
    """
    columns = [F.col(f"`{c}`").cast("string").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return docs.select(F.struct(*columns).alias("row"), *[c.alias(name) for name, c in more.items()])


def unpacked(df: DataFrame, columns: list[str], **more) -> DataFrame:
    """The columns of ``row``, then the columns ``more``."""
    return df.select(*[F.col("row").getField(c).alias(c) for c in columns], *[c.alias(name) for name, c in more.items()])


def with_field(rows: pa.StructArray, name: str, values: list) -> pa.StructArray:
    """The rows with other values in one field."""
    fields = list(rows.type)
    arrays = [pa.array(values, f.type) if f.name == name else rows.field(i) for i, f in enumerate(fields)]
    return pa.StructArray.from_arrays(arrays, fields=fields)


_kept: dict[str, Callable[[], None]] = {}


def keep(name: str, forget: Callable[[], None]) -> None:
    """This process keeps a memory between tasks; ``forget`` empties it."""
    _kept[name] = forget


def _release(but: str | None) -> None:
    """Empty the memories that other operators' tasks left in this process."""
    for name in [n for n in _kept if n != but]:
        _kept.pop(name)()


def map_batches(df: DataFrame, fn, schema: str, memory: str | None = None) -> DataFrame:
    """``fn`` over each Arrow batch; it returns a dict of columns (or None for no rows).

    Outputs are cut to the schema's order and types.  Workers serve tasks of many
    operators: a task first empties the memories of others, but for ``memory``,
    the name under which ``fn`` keeps its own (see ``keep``).
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches):
        _release(memory)
        for batch in batches:
            step = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
            for cols in (c for at in range(0, batch.num_rows, step) for c in fn(batch.slice(at, step))):
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, type=f.type)
                     for f, c in ((f, cols[f.name]) for f in target)], schema=target)

    return df.mapInArrow(run, schema)


def list_column(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """An Arrow list<int64> column from flat values and each row's count."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64)))
