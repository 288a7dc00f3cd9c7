"""Line deduplication by windows over line hashes (operator 10).

A line is the text between \\n; lines without a word are passed over.  A
window is the shortest run of lines of at least ``min_words`` words that
starts, or that ends, at some line.  All windows are kept and joined on the
hash of their contents; unlike winnowing, which keeps the positions of least
hashes only and extends each match, nothing is selected (the least line hash
in the key is implied by the contents) and no pair of positions is made, which
for a run that stands in many texts would grow with their square.  A window that an earlier position has
as well is a later copy; windows that start at a line carry a match on from
its beginning and windows that end at a line carry it to its end, so their
union is the repeated run at full length.  Earlier: the smaller id, within a
text the smaller line.

All that is shuffled by fingerprint is a minimum and a maximum id (combined
before the shuffle) and one join back, never pairs of positions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.components import stored
from lakemart.llm.textblocks import SPACE_WORD, U, Block, blocks, map_batches, mix, packed, row_of, unpacked, with_field

_STEP = 0x9E3779B97F4A7C15


def _run_hashes(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of the sequence values[lo..hi] (hi inclusive) of each run."""
    n = np.arange(len(values) + 1, dtype=U)
    up, down = np.ones(len(values) + 1, U), np.ones(len(values) + 1, U)
    up[1:] = U(_STEP)
    down[1:] = U(pow(_STEP, -1, 1 << 64))
    up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
    sums = np.zeros(len(values) + 1, U)
    np.cumsum(mix(values) * up[:-1], out=sums[1:])
    return mix((sums[hi + 1] - sums[lo]) * down[lo] + n[hi - lo + 1])


def windows(block: Block, min_words: int) -> tuple[np.ndarray, ...]:
    """(row, first line, last line, fingerprint, contents) of every window of the block's texts."""
    start, end, first = block.lines()
    word = block.words(SPACE_WORD)[0]
    count = np.searchsorted(word, end) - np.searchsorted(word, start)
    row = row_of(first)
    number = np.arange(len(start)) - first[row]
    used = count > 0
    start, end, count, row, number = start[used], end[used], count[used], row[used], number[used]
    if not len(start):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U),) * 2
    line = block.span_hash(start, end)
    begins = np.searchsorted(row, row)
    ends = np.searchsorted(row, row, "right")
    total = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(len(line))
    last = np.searchsorted(total, total[:-1] + min_words) - 1
    opening = last < ends
    back = np.searchsorted(total, total[1:] - min_words, "right") - 1
    closing = back >= begins
    lo = np.concatenate([at[opening], back[closing]])
    hi = np.concatenate([last[opening], at[closing]])
    if not len(lo):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U),) * 2
    lo, hi = np.unique(np.stack([lo, hi]), axis=1) if len(lo) < 2 else np.divmod(np.unique(lo * len(line) + hi), len(line))
    cuts = np.stack([lo, hi + 1], axis=1).ravel()
    least = np.minimum.reduceat(np.append(line, U((1 << 64) - 1)), cuts)[::2]
    return row[lo], number[lo], number[hi], least, _run_hashes(line, lo, hi)


def _positions(min_words: int):
    def rows(batch):
        ids, marks = batch.column("doc_id").to_numpy(), batch.column("mark").to_numpy()
        for block in blocks(batch.column("text")):
            row, lo, hi, least, contents = windows(block, min_words)
            if not len(row):
                continue
            # a run that its own text has before
            key = np.stack([row.astype(U), least, contents])
            order = np.lexsort((lo, contents, least, row))
            again = np.zeros(len(row), bool)
            again[order[1:]] = (key[:, order[1:]] == key[:, order[:-1]]).all(axis=0)
            at = row + block.first_row
            yield {"doc_id": ids[at], "mark": marks[at], "lo": lo.astype(np.int32), "hi": hi.astype(np.int32),
                   "fingerprint": least.astype(np.int64), "contents": contents.astype(np.int64), "again": again}

    return rows


def _strip(text: str, spans: list[tuple[int, int]]) -> tuple[str, int]:
    """The text without the lines of the spans, and how many lines with words went."""
    lines = text.split("\n")
    gone = np.zeros(len(lines), bool)
    for lo, hi in spans:
        gone[lo:hi + 1] = True
    kept, removed, follows = [], 0, False
    for line, out in zip(lines, gone.tolist()):
        blank = not line.strip(" \t\n\v\f\r")
        removed += out and not blank
        follows = out or (follows and blank)  # blank lines go with the run before them
        if not follows:
            kept.append(line)
    return "\n".join(kept), removed


def _apply(text_col: str):
    def rows(batch):
        row, los, his = batch.column("row"), batch.column("los").to_pylist(), batch.column("his").to_pylist()
        out, gone, lines = [], [], []
        for text, lo, hi in zip(row.field(text_col).to_pylist(), los, his):
            lines.append(text.count("\n") + 1 if text else 0)
            kept, n = (text, 0) if not lo else _strip(text, list(zip(lo, hi)))
            out.append(kept)
            gone.append(n)
        yield {"row": with_field(row, text_col, out), "n_lines": lines, "n_removed": gone}

    return rows


def repeated_spans(texts: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, mark, lo, hi): the windows of lines lo..hi that an earlier position has as well."""
    spark = texts.sparkSession
    found = stored(map_batches(texts.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "mark", "text"),
                               _positions(min_words),
                               "doc_id long, mark long, lo int, hi int, fingerprint long, contents long, again boolean"),
                   spark, "line-windows")
    key = ["fingerprint", "contents"]
    twice = found.groupBy(*key).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("top")).where("first < top")
    across = found.join(twice.select(*key, "first"), key).where("doc_id > first").select("doc_id", "mark", "lo", "hi")
    return across.unionAll(found.where("again").select("doc_id", "mark", "lo", "hi"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50,
                counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """The rows of ``docs`` with ``text_col`` cleared of later repeated runs of lines, and n_lines, n_removed.

    A run repeats if its lines, at least ``min_words`` words together, stand in
    the same order in a text with a smaller id or earlier in the same text.
    The other columns stay as they are.  ``counts`` names the two new columns;
    columns of ``docs`` with these names are replaced.  Blank lines right after a
    removed run go with it.

    Nulls: a null text stays null with no lines.  Rows without id stay whole
    and are compared with none.  Rows with equal ids count as one text's
    position: none of them is earlier than the other.  Repeated rows lose the
    same lines.  Texts are whole.  An empty table gives no rows; an empty text has
    no lines and stays empty.
    """
    columns = [c for c in docs.columns if c not in counts]
    rows = packed(docs.select(*[F.col(f"`{c}`") for c in columns]), text_col,
                  doc_id=F.col(id_col).cast("long"), mark=F.xxhash64(F.col(text_col).cast("string")))
    texts = rows.select("doc_id", F.col("row").getField(text_col).alias("text"), "mark")
    # a set: repeated rows have the same spans
    spans = (repeated_spans(texts, min_words).groupBy("doc_id", "mark")
             .agg(F.collect_set(F.struct("lo", "hi")).alias("spans")))
    joined = rows.join(spans, ["doc_id", "mark"], "left").select(
        "row", F.col("spans.lo").alias("los"), F.col("spans.hi").alias("his"))
    schema = joined.select("row").schema.add("n_lines", "long").add("n_removed", "long")
    done = map_batches(joined, _apply(text_col), schema)
    return unpacked(done, columns, **{counts[0]: F.col("n_lines"), counts[1]: F.col("n_removed")})
