"""Benchmark decontamination with SimHash windows (operator 7).

Words are runs of letters and digits, lower-cased, so line breaks and
punctuation don't hide a passage.  A document is read through windows of each
item's own size.  A window's 64-bit SimHash sums the hashes of its word
shingles, each weighted by the letters in it.  A multi-index finds the items
near it: the fingerprint is cut into RADIUS + 1 blocks, and of two
fingerprints that differ in at most RADIUS bits at least one block is equal.
Items within the radius are then held against the window by exact weighted
Jaccard similarity of their shingles.

A window without a single shingle of any item has similarity 0, so windows are
taken only where some item's shingle stands; this leaves out no match.

The items are a query set: they are read in blocks of at most ``item_block``,
and each block is held against all documents in one pass without a shuffle.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.textblocks import ALNUM_WORD, U, Block, blocks, map_batches, packed, row_of, shingles, unpacked

#: Bits in which a window's fingerprint may differ from an item's. At a similarity
#: of 0.8 about 10 of 64 bits differ, with a deviation of 3.
RADIUS = 18
_CUTS = [64 * i // (RADIUS + 1) for i in range(RADIUS + 2)]
_BITS = U(1) << np.arange(64, dtype=U)
#: Words over which windows are fingerprinted at once, and running sums held for it.
WINDOWS, SUMS = 1 << 14, 1 << 21


def _words(block: Block):
    start, end, first = block.words(ALNUM_WORD)
    letters = np.concatenate([[0], np.cumsum(end - start)])
    return block.span_hash(start, end), letters, first


def _fingerprints(sh: np.ndarray, weight: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """SimHash of the shingles lo..hi (hi exclusive) of each window: running sums of +weight or -weight for each bit.

    As many bits at a time as SUMS numbers hold, so long runs take no more memory than their shingles.
    """
    out = np.zeros(len(lo), U)
    step = max(1, min(64, SUMS // max(1, len(sh))))
    for at in range(0, 64, step):
        bits = _BITS[at:at + step]
        signed = np.where((sh[:, None] & bits) != 0, weight[:, None], -weight[:, None])
        sums = np.concatenate([np.zeros((1, len(bits)), np.int64), np.cumsum(signed, axis=0)])
        out |= np.where(sums[hi] - sums[lo] > 0, bits, U(0)).sum(axis=1, dtype=U)
    return out


def window_starts(hits: list[int], lo: int, hi: int, span: int, length: int) -> Iterator[np.ndarray]:
    """Starts of the windows of ``length`` words within lo..hi that hold a hit in their first ``span`` places.

    Each start once, ascending, in parts that reach over at most WINDOWS words
    and are made one at a time.
    """
    p = np.unique(np.array(hits, np.int64))
    first, last = np.maximum(lo, p - span + 1), np.minimum(p, hi - length)
    first, last = first[first <= last], last[first <= last]
    if not len(first):
        return
    run = np.flatnonzero(np.concatenate([[True], first[1:] > last[:-1] + 1]))
    held: list[np.ndarray] = []
    for a, b in zip(first[run].tolist(), last[np.append(run[1:], len(last)) - 1].tolist(), strict=True):
        while a <= b:
            if held and a >= held[0][0] + WINDOWS:
                yield np.concatenate(held)
                held = []
            upto = min(b, (int(held[0][0]) if held else a) + WINDOWS - 1)
            held.append(np.arange(a, upto + 1))
            a = upto + 1
    yield np.concatenate(held)


class Sized:
    """The items of one size in words, with their multi-index."""

    def __init__(self, words: int, k: int):
        self.words, self.k = words, min(k, words)
        self.ids, self.counts, self.totals, self.prints = [], [], [], []

    def add(self, item_id: int, sh: np.ndarray, weight: np.ndarray) -> None:
        counts: dict[int, list[int]] = {}
        for h, w in zip(sh.tolist(), weight.tolist()):
            counts.setdefault(h, [0, w])[0] += 1
        self.ids.append(item_id)
        self.counts.append(counts)
        self.totals.append(int(weight.sum()))
        self.prints.append(_fingerprints(sh, weight, np.array([0]), np.array([len(sh)]))[0])

    def close(self) -> Sized:
        self.prints = np.array(self.prints, U)
        self.index = []
        for lo, hi in zip(_CUTS[:-1], _CUTS[1:]):
            part = (self.prints >> U(lo)) & U((1 << (hi - lo)) - 1)
            order = np.argsort(part, kind="stable")
            self.index.append((U(lo), U((1 << (hi - lo)) - 1), part[order], order))
        return self

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (window, item) within the radius, by the blocks they share."""
        found = []
        for shift, mask, part, order in self.index:
            own = (prints >> shift) & mask
            lo, hi = np.searchsorted(part, own), np.searchsorted(part, own, "right")
            n = hi - lo
            stop = np.cumsum(n)
            at = np.arange(stop[-1]) + np.repeat(lo - (stop - n), n)
            found.append(np.repeat(np.arange(len(prints)), n) * len(self.ids) + order[at])
        window, item = np.divmod(np.unique(np.concatenate(found)), len(self.ids))
        ok = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
        return window[ok], item[ok]


class Items:
    """A block of benchmark items: their shingles for the first look, and the sized groups."""

    def __init__(self, rows: list[tuple[int, str]], k: int):
        self.k, groups, owners = k, {}, defaultdict(lambda: defaultdict(set))
        for item_id, text in rows:
            for block in blocks(pa.array([text or ""]), lower=True):
                wh, letters, first = _words(block)
                if not len(wh):
                    continue
                size = len(wh)
                part = min(k, size)
                sh = shingles(wh, first, part)[0][:size - part + 1]
                weight = letters[part:part + len(sh)] - letters[:len(sh)]
                groups.setdefault(size, Sized(size, k)).add(item_id, sh, weight)
                for h in sh.tolist():
                    owners[part][h].add(size)
        self.groups = {n: g.close() for n, g in groups.items()}
        #: by shingle length: sorted hashes, a coarse table of their low bits, and the sizes that have them
        self.look = {}
        for part, by_hash in owners.items():
            known = np.array(sorted(by_hash), U)
            table = np.zeros(1 << 20, bool)
            table[known & U((1 << 20) - 1)] = True
            self.look[part] = (known, table, [sorted(by_hash[h]) for h in known.tolist()])


def _weighted(counts: dict[int, list[int]], total: int, sh: list[int], weight: np.ndarray) -> float:
    shared = sum(min(n, counts[h][0]) * counts[h][1] for h, n in Counter(sh).items() if h in counts)
    union = total + int(weight.sum()) - shared
    return shared / union if union else 0.0


def scan(block: Block, items: Items, similarity: float) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, item id, similarity, first word, last word) of the best window of each row and item that match."""
    wh, letters, first = _words(block)
    rows = row_of(first)
    for part, (known, table, sizes_of) in items.look.items():
        sh, whole = shingles(wh, first, part)
        hit = np.flatnonzero(table[sh & U((1 << 20) - 1)] & whole)
        at = np.searchsorted(known, sh[hit])
        same = known[np.minimum(at, len(known) - 1)] == sh[hit]
        hit, at = hit[same], at[same]
        places: dict[tuple[int, int], list[int]] = defaultdict(list)
        for p, a in zip(hit.tolist(), at.tolist()):
            for size in sizes_of[a]:
                places[(int(rows[p]), size)].append(p)
        for (row, size), hits in places.items():
            group = items.groups[size]
            lo, hi = int(first[row]), int(first[row + 1])
            length = min(size, hi - lo)
            span = length - part + 1
            best: dict[int, tuple[float, int]] = {}
            for starts in window_starts(hits, lo, hi, span, length):
                a, b = int(starts[0]), int(starts[-1]) + span
                local, weight = sh[a:b], letters[a + part:b + part] - letters[a:b]
                window, item = group.near(_fingerprints(local, weight, starts - a, starts - a + span))
                total = np.concatenate([[0], np.cumsum(weight)])
                for i in np.unique(item).tolist():
                    counts, own = group.counts[i], group.totals[i]
                    inside = np.concatenate([[0], np.cumsum(np.where(np.isin(local, np.fromiter(counts, U, len(counts))), weight, 0))])
                    at_ = starts[window[item == i]] - a
                    most = inside[at_ + span] - inside[at_]
                    bound = most / np.maximum(own + total[at_ + span] - total[at_] - most, 1)
                    top, where = best.get(i, (0.0, -1))
                    for j in np.argsort(-bound, kind="stable").tolist():
                        if bound[j] < similarity or bound[j] < top:
                            break
                        s = int(at_[j])
                        value = _weighted(counts, own, local[s:s + span].tolist(), weight[s:s + span])
                        if value >= similarity and (value > top or value == top and a + s < where):
                            top, where = value, a + s
                    if where >= 0:
                        best[i] = top, where
            for i, (value, where) in sorted(best.items()):
                yield row + block.first_row, group.ids[i], value, where - lo, where - lo + length - 1


def _item_blocks(benchmark: DataFrame, item_id: str, text_col: str, size: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most ``size``, one partition of them on the driver at a time."""
    rows: list[tuple[int, str]] = []
    items = benchmark.select(F.col(item_id).cast("long"), F.col(text_col).cast("string")).na.drop().distinct()
    for r in items.toLocalIterator():
        rows.append((r[0], r[1]))
        if len(rows) == size:
            yield rows
            rows = []
    if rows:
        yield rows


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text", k: int = 5, similarity: float = 0.8,
                 item_block: int = 5000) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, last_word): each document that holds an item, at its best window.

    Words count from 0 within the text.  Equal windows: the first.  Items of
    fewer than k words are one shingle; a text shorter than an item is one
    window.

    Nulls: documents or items without text or words match nothing; items
    without id are left out; a document without id gives rows with a null
    doc_id.  Repeated document rows give a row each, repeated items one.
    Other columns are left aside.  Empty tables give no rows.
    """
    return _matches(docs, benchmark, id_col, text_col, item_id, item_text, k, similarity, item_block).drop("mark")


def _matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_id: str = "item_id", item_text: str = "text", k: int = 5, similarity: float = 0.8,
             item_block: int = 5000) -> DataFrame:
    """The rows of contaminated with ``mark``, the hash of the document's text."""
    spark: SparkSession = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.withColumn("mark", F.xxhash64("text"))
    schema = "doc_id long, mark long, item_id long, similarity double, first_word long, last_word long"
    out = spark.createDataFrame([], schema)
    for rows in _item_blocks(benchmark, item_id, item_text, item_block):
        sent = spark.sparkContext.broadcast(Items(sorted(rows), k))

        def search(batch, sent=sent):
            ids, marks = batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist()
            for block in blocks(batch.column("text"), lower=True):
                if got := list(scan(block, sent.value, similarity)):
                    row, item, value, lo, hi = zip(*got)
                    yield {"doc_id": [ids[r] for r in row], "mark": [marks[r] for r in row], "item_id": list(item), "similarity": list(value),
                           "first_word": list(lo), "last_word": list(hi)}

        out = out.unionAll(map_batches(texts, search, schema))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text has no match in the benchmark, also those without id.

    Rows go by id and text: another text of the same id stays.  Null and empty
    texts match nothing and stay; repeated rows stay or go together.  All columns
    are kept, whatever their names; an empty table gives no rows.
    """
    bad = _matches(docs, benchmark, id_col, text_col, **options).select(F.col("doc_id").alias("bad_id"), F.col("mark").alias("bad")).distinct()
    rows = packed(docs, text_col, doc_id=F.col(id_col).cast("long"), mark=F.xxhash64(F.col(text_col).cast("string")))
    return unpacked(rows.join(bad, F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.col("mark") == F.col("bad")), "left_anti"),
                    docs.columns)
