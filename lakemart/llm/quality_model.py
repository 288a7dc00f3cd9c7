"""Quality classifier: hashed word n-grams, logistic regression by FTRL (operator 6).

Tokens are runs of letters and digits, or runs of other marks.  Features are
the hashes of single tokens and of token pairs, in 2^20 slots; a pair of equal
tokens is one feature whatever the token, and so is a token all in capitals.
A document's value for a feature is the feature's share of all its features,
so a score is one sparse dot product.

Training follows the regularised leader (per-coordinate rates, L1 and L2) over
a sample of at most ``max_rows`` labelled rows, chosen by a hash of the id.
Only their hashed features go to the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.textblocks import ALNUM_WORD, SPACE_WORD, U, Block, blocks, list_column, map_batches, mix, row_of

SLOTS = 1 << 20
_SAME, _CAPITALS = 1, 2
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of each feature of the block's texts."""
    marks = SPACE_WORD & ~ALNUM_WORD
    a0, a1, _ = block.words(ALNUM_WORD)
    b0, b1, _ = block.words(marks)
    start, end = np.concatenate([a0, b0]), np.concatenate([a1, b1])
    order = np.argsort(start, kind="stable")
    start, end = start[order], end[order]
    first = np.searchsorted(start, block.offsets)
    row, h = row_of(first), block.span_hash(start, end)
    upper = np.concatenate([[0], np.cumsum(_UPPER[block.data])])
    loud = np.flatnonzero((upper[end] - upper[start] == end - start) & (end - start > 1))
    pair = np.flatnonzero(row[1:] == row[:-1]) if len(row) else np.zeros(0, np.int64)
    both = mix(h[pair] * U(3) + mix(h[pair + 1]))
    both[h[pair] == h[pair + 1]] = U(_SAME)
    slots = np.concatenate([h & U(SLOTS - 1), both & U(SLOTS - 1), np.full(len(loud), _CAPITALS, U)]).astype(np.int64)
    return np.concatenate([row, row[pair], row[loud]]), slots


def _sparse(batch):
    ids, label = batch.column("doc_id").to_numpy(), batch.column("quality").to_numpy()
    for block in blocks(batch.column("text")):
        row, slot = features(block)
        key, n = np.unique(row * SLOTS + slot, return_counts=True)
        counts = np.bincount(key // SLOTS, minlength=block.rows)
        here = slice(block.first_row, block.first_row + block.rows)
        yield {"doc_id": ids[here], "quality": label[here], "slots": list_column(key % SLOTS, counts),
               "n": list_column(n, counts)}


class Ftrl:
    """Follow the regularised leader for logistic loss."""

    def __init__(self, alpha: float = 1.0, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)  # the last slot is the bias

    def weights(self, slots=slice(None)) -> np.ndarray:
        z = self.z[slots]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[slots])) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def update(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(slots)
        error = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35))) - label
        g = error * values
        n = self.n[slots]
        self.z[slots] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[slots] = n + g * g


#: Documents' shares are small numbers; they are multiplied by this.
SCALE = 30.0


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, epochs: int = 4) -> np.ndarray:
    """Weights (slots, then the bias) from at most ``max_rows`` labelled rows outside the held-out third.

    Labels other than 0 and 1, and labels without id, are left out; of several
    labels for one id the least counts.  Without labelled rows all are 0.
    """
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out("doc_id"))
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = map_batches(texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text"), _sparse,
                       "doc_id long, quality int, slots array<long>, n array<long>").toArrow()
    model = Ftrl()
    if rows.num_rows:
        slots, counts = rows.column("slots").combine_chunks(), rows.column("n").combine_chunks()
        off = np.concatenate([[0], np.cumsum(slots.value_lengths().to_numpy())])
        slot, n = slots.flatten().to_numpy(), counts.flatten().to_numpy()
        label, ids = rows.column("quality").to_numpy(), rows.column("doc_id").to_numpy()
        order = np.lexsort((ids, mix(ids.astype(U))))
        for _ in range(epochs):
            for i in order.tolist():
                part = slice(off[i], off[i + 1])
                share = SCALE * n[part] / max(1, n[part].sum())
                model.update(np.append(slot[part], SLOTS), np.append(share, 1.0), int(label[i]))
    return model.weights()


def held_out(id_col: str):
    """Whether a row's label is kept from training: crc32 of the id as text, mod 3, is 1 (never for null ids)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    A null or empty text has no features: its score is the bias's.  Rows
    without id are scored as any other; repeated rows give a row each; other
    columns are left aside; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def rows(batch):
        ids, out = batch.column("doc_id"), batch.column("held_out")
        for block in blocks(batch.column("text")):
            w = sent.value
            row, slot = features(block)
            total = np.bincount(row, w[slot], block.rows)
            count = np.maximum(np.bincount(row, minlength=block.rows), 1)
            value = 1 / (1 + np.exp(-np.clip(w[SLOTS] + SCALE * total / count, -35, 35)))
            here = (block.first_row, block.rows)
            yield {"doc_id": ids.slice(*here), "held_out": out.slice(*here), "score": value,
                   "predicted": (value >= 0.5).astype(np.int32)}

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(texts.withColumn("held_out", held_out("doc_id")).select("doc_id", "held_out", "text"), rows,
                       "doc_id long, held_out boolean, score double, predicted int")
