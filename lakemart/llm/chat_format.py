"""Conversations as training text with an offset-aligned loss mask (operator 11).

The turns of a conversation are rendered to one text, the text is encoded once
and every token keeps its byte span.  The mask is the intersection of the
sorted spans of the assistant's texts with the sorted spans of the tokens,
found by binary search.

Rows are range-partitioned by (conversation, turn), so a conversation with a
large share of all rows goes to many tasks, each of which renders and encodes
a run of its turns.  A run's encoding doesn't depend on the runs around it:
each turn starts and ends with a control string, which is a token of its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.bpe import read_ranks

#: Code points of rendered turns in a row of the output (or one turn, if that is longer).
PIECE_CHARS = 1 << 18
#: Code points that are encoded at once; a longer text is cut where no token can lie across.
SLICE_CHARS = 1 << 18
#: Bytes of a conversation's turns that a task of ``read_back`` holds before it passes them on.
HOLD_BYTES = 1 << 22
#: Label of tokens outside the loss.
IGNORED = -100

# a space between two visible characters starts a match of the splitting pattern (see bpe.Encoder)
_CUT = re.compile(r"(?<=\S) (?=\S)")


@dataclass(frozen=True)
class Template:
    """Control strings around a turn, and how texts that hold them are escaped.

    A turn is ``turn + role + text + text + end`` with role and text escaped:
    a backslash is doubled, and one is put behind the first character of each
    control or reserved string.  ``reserved``: control strings of other
    templates, which don't stand in an output as such either.
    """

    turn: str = "<|turn|>"
    text: str = "<|text|>"
    end: str = "</s>"
    reserved: tuple[str, ...] = ("<s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>")
    loss_roles: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        every = (*self.controls, *self.reserved)
        if len(set(self.controls)) < 3 or any(len(c) < 2 or "\\" in c or " " in c for c in every):
            raise ValueError("control strings must differ, have two characters or more, and neither backslash nor space")
        if any(a[-n:] == b[:n] for a in every for b in every for n in range(1, min(len(a), len(b)) + (a != b))
               if n < len(a) or n < len(b)):
            raise ValueError("the end of a control string must not be the start of one")

    @property
    def controls(self) -> tuple[str, str, str]:
        return self.turn, self.text, self.end

    @cached_property
    def _found(self) -> re.Pattern:
        return re.compile(r"\\|(?=%s)." % "|".join(map(re.escape, (*self.controls, *self.reserved))), re.S)

    @cached_property
    def _starts(self) -> frozenset[str]:
        return frozenset(c[0] for c in ("\\", *self.controls, *self.reserved))

    def escape(self, s: str) -> str:
        return self._found.sub(lambda m: m[0] + "\\", s) if any(c in s for c in self._starts) else s

    @staticmethod
    def unescape(s: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", s) if "\\" in s else s

    def render(self, role: str, text: str) -> tuple[str, str, str]:
        """What stands before the escaped text, that text, and what stands behind it."""
        return self.turn + self.escape(role) + self.text, self.escape(text), self.end

    def parse(self, rendered: str) -> list[tuple[str, str]]:
        """The (role, text) of rendered turns, unescaped."""
        turns = []
        for one in rendered.split(self.end)[:-1]:
            role, mark, text = one.removeprefix(self.turn).partition(self.text)
            if not mark or not one.startswith(self.turn):
                raise ValueError("not a rendered turn")
            turns.append((self.unescape(role), self.unescape(text)))
        return turns


class ChatEncoder:
    """Ids and byte spans of rendered text; control strings get the ids behind the vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, template: Template):
        top = max(ranks.values()) + 1
        special = {c: top + i for i, c in enumerate(template.controls)}
        self._encoding = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self._bytes = np.zeros(top + len(special), np.int64)
        for token, rank in ranks.items():
            self._bytes[rank] = len(token)
        for token, rank in special.items():
            self._bytes[rank] = len(token.encode())

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, byte ends); a token starts where the one before it ends."""
        parts, at = [], 0
        while at < len(text):
            upto = len(text)
            if upto - at > SLICE_CHARS:
                cut = _CUT.search(text, at + SLICE_CHARS)
                upto = cut.start() if cut else upto
            parts.append(self._encoding.encode_to_numpy(text[at:upto], allowed_special="all").astype(np.int32))
            at = upto
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        return ids, np.cumsum(self._bytes[ids])


def mask_of(ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens have a byte in one of the sorted, disjoint spans (start, end)."""
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    span = np.array([s for s in spans if s[0] < s[1]], np.int64).reshape(-1, 2)
    change = np.zeros(len(ends) + 1, np.int64)
    np.add.at(change, np.searchsorted(ends, span[:, 0], "right"), 1)
    np.add.at(change, np.searchsorted(starts, span[:, 1], "left"), -1)
    return np.cumsum(change[:-1]) > 0


@lru_cache(maxsize=2)
def _encoder(ranks: bytes, pattern: str, template: Template) -> ChatEncoder:
    return ChatEncoder(read_ranks(ranks), pattern, template)


PIECES = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("tie", pa.int64()), ("seq", pa.int64()),
                    ("n_turns", pa.int64()), ("formatted", pa.string()), ("ids", pa.list_(pa.int32())),
                    ("ends", pa.list_(pa.int32())), ("labels", pa.list_(pa.int32()))])
PIECES_DDL = ("conv_id long, turn long, tie long, seq long, n_turns long, formatted string, ids array<int>, "
              "ends array<int>, labels array<int>")


def _rows(batches) -> Iterator[dict]:
    """The batches' rows, a few at a time as Python values."""
    for batch in batches:
        step = max(1, min(1024, batch.num_rows * (1 << 22) // max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield from batch.slice(at, step).to_pylist()


def _pieces(batches) -> Iterator[dict]:
    """The rows of ``format_conversations``; ends and labels as arrays."""
    for batch in batches:
        lists = {}
        for c in ("ends", "labels"):
            column = batch.column(c)
            lists[c] = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
        columns = [batch.column(c) for c in ("conv_id", "turn", "tie", "seq", "formatted")]
        for i in range(batch.num_rows):
            conv, turn, tie, seq, formatted = (c[i].as_py() for c in columns)
            yield {"conv_id": conv, "turn": turn, "tie": tie, "seq": seq, "formatted": formatted,
                   **{c: values[at[i]:at[i + 1]] for c, (at, values) in lists.items()}}


def format_conversations(rows: DataFrame, ranks: bytes, pattern: str, template: Template = Template(),
                         piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Runs of rendered and encoded turns for the rows (conv_id, turn, role, text).

    Each output row has a run of turns of one conversation: the ``formatted``
    text, its token ``ids``, the byte end of each token in the text (``ends``)
    and ``labels`` (the id where the loss counts, else -100).  A conversation's
    formatted text is the texts of its rows by (turn, tie, seq), and so for the
    ids.  Most conversations have one row; long ones, and those at a
    partition's border, have more.

    Turns go by ``turn``, those of null first; turns of equal number by a hash
    of role and text.  Repeated rows are turns of their own.  Null role or
    text: empty.  Null conv_id: one conversation.  Texts are whole; further
    columns are left aside; an empty table gives no rows.
    """
    sent = rows.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        encoder = _encoder(sent.value, pattern, template)
        held, head, size, seq = [], None, 0, 0

        def piece():
            texts, spans, at = [], [], 0
            for r in held:
                before, text, behind = template.render(r["role"] or "", r["text"] or "")
                start = at + len(before.encode())
                end = start + len(text.encode())
                at = end + len(behind.encode())
                texts += (before, text, behind)
                if r["role"] in template.loss_roles:
                    spans.append((start, end))
            formatted = "".join(texts)
            ids, ends = encoder.encode(formatted)
            labels = np.where(mask_of(ends, spans), ids, np.int32(IGNORED))
            lists = [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(v.astype(np.int32)))
                     for v in (ids, ends, labels)]
            scalars = [pa.array([v], t) for v, t in ((head["conv_id"], pa.int64()), (head["turn"], pa.int64()),
                       (head["tie"], pa.int64()), (seq, pa.int64()), (len(held), pa.int64()), (formatted, pa.string()))]
            return pa.RecordBatch.from_arrays(scalars + lists, schema=PIECES)

        ready, ready_bytes = [], 0
        for r in _rows(batches):
            n = len(r["text"] or "") + len(r["role"] or "")
            if held and (r["conv_id"] != head["conv_id"] or size + n > piece_chars):
                ready.append(piece())
                ready_bytes += ready[-1].nbytes
                held, size, seq = [], 0, seq + 1
                if ready_bytes > 1 << 22:
                    yield pa.Table.from_batches(ready).combine_chunks().to_batches()[0]
                    ready, ready_bytes = [], 0
            if not held:
                head = r
            held.append(r)
            size += n
        if held:
            ready.append(piece())
        if ready:
            yield pa.Table.from_batches(ready).combine_chunks().to_batches()[0]

    turns = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.xxhash64("role", "text").alias("tie"), F.col("role").cast("string").alias("role"),
                        F.col("text").cast("string").alias("text"))
    order = ("conv_id", "turn", "tie")
    return turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, PIECES_DDL)


def loss_text(formatted: bytes, ends: np.ndarray, labels: np.ndarray, template: Template) -> str:
    """The text under the mask, unescaped."""
    inside = np.concatenate([[False], labels != IGNORED, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts = np.concatenate([[0], ends])
    parts = [formatted[starts[a]:starts[b]] for a, b in zip(edge[::2], edge[1::2], strict=True)]
    return template.unescape(b"".join(parts).decode())


_PART = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("tie", pa.int64()), ("seq", pa.int64()),
                   ("n_turns", pa.int64()), ("loss_chars", pa.int64()), ("formatted_chars", pa.int64()),
                   ("turns", pa.binary()), ("loss", pa.binary()), ("turns_sha256", pa.string()), ("loss_sha256", pa.string())])
_PART_DDL = ("conv_id long, turn long, tie long, seq long, n_turns long, loss_chars long, formatted_chars long, "
             "turns binary, loss binary, turns_sha256 string, loss_sha256 string")
_OUT = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                  ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
_OUT_DDL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _batched(rows: Iterator[dict], schema: pa.Schema, size=lambda r: 200) -> Iterator[pa.RecordBatch]:
    held, total = [], 0
    for r in rows:
        held.append(r)
        total += size(r)
        if total > 1 << 21:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _parts(pieces: Iterator[dict], template: Template, hold_bytes: int) -> Iterator[dict]:
    """What was read from the pieces: digests of conversations that surely lie in this partition, else their bytes."""
    held, size, whole, last = [], 0, False, None

    def digests():
        return {**held[0], **{c: sum(p[c] for p in held) for c in ("n_turns", "loss_chars", "formatted_chars")},
                **{f"{c}_sha256": hashlib.sha256(b"".join(p[c] for p in held)).hexdigest() for c in ("turns", "loss")},
                "turns": None, "loss": None}

    for p in pieces:
        if last is None or p["conv_id"] != last[0]:
            if held and whole:
                yield digests()
            else:
                yield from held
            # a partition's first conversation may have begun in another one
            held, size, whole = [], 0, last is not None
            last = (p["conv_id"],)
        turns = template.parse(p["formatted"])
        loss = loss_text(p["formatted"].encode(), p["ends"], p["labels"], template)
        held.append({"conv_id": p["conv_id"], "turn": p["turn"], "tie": p["tie"], "seq": p["seq"], "n_turns": len(turns),
                     "loss_chars": len(loss), "formatted_chars": len(p["formatted"]), "loss": loss.encode(),
                     "turns": "".join(f"{role}\n{text}\n" for role, text in turns).encode()})
        size += len(held[-1]["turns"]) + len(held[-1]["loss"])
        if size > hold_bytes:
            yield from held
            held, size, whole = [], 0, False
    yield from held  # the last one may go on in another partition


def _joined(parts: Iterator[dict]) -> Iterator[dict]:
    """One row per conversation from its parts in order; digests run over the parts as they come."""
    now, sums, turns, loss = None, {}, None, None

    def row():
        return {**sums, "turns_sha256": turns.hexdigest(), "loss_sha256": loss.hexdigest()}

    for p in parts:
        if p["turns_sha256"] is not None:
            yield p
            continue
        if now is None or now != (p["conv_id"],):
            if now is not None:
                yield row()
            now, turns, loss = (p["conv_id"],), hashlib.sha256(), hashlib.sha256()
            sums = {"conv_id": p["conv_id"], "n_turns": 0, "loss_chars": 0, "formatted_chars": 0}
        for c in ("n_turns", "loss_chars", "formatted_chars"):
            sums[c] += p[c]
        turns.update(p["turns"])
        loss.update(p["loss"])
    if now is not None:
        yield row()


def read_back(pieces: DataFrame, template: Template = Template(), hold_bytes: int = HOLD_BYTES) -> DataFrame:
    """Per conversation what its formatted text, offsets and labels say, from ``format_conversations``'s rows.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).
    A SHA-256 of a conversation runs over its turns one after the other.  Where
    a conversation lies in several partitions, its turns are sent on in
    order to one task, which reads them as a stream and holds one part at a
    time; only those conversations' texts are sent a second time.  Pieces must
    come partition by partition as ``format_conversations`` makes them.  An
    empty table gives no rows.
    """
    parts = pieces.mapInArrow(lambda batches: _batched(
        _parts(_pieces(batches), template, hold_bytes), _PART, lambda r: 200 + len(r["turns"] or b"") + len(r["loss"] or b"")), _PART_DDL)
    dealt = parts.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "tie", "seq")
    return dealt.mapInArrow(lambda batches: _batched(_joined(_rows(batches)), _OUT), _OUT_DDL)


def oracle_sql(template: Template = Template()) -> str:
    """DuckDB SQL for ``op11_chat_format``'s rows."""
    def escaped(column: str) -> str:
        sql = f"replace({column}, '\\', '\\\\')"
        for c in (*template.controls, *template.reserved):
            sql = f"replace({sql}, '{c}', '{c[0]}\\{c[1:]}')"
        return sql

    roles = ", ".join(f"'{r}'" for r in template.loss_roles)
    marks = sum(map(len, template.controls))
    return f"""
WITH rows_ AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(sum(CASE WHEN role IN ({roles}) THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role IN ({roles}) THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
       CAST(sum({marks} + length({escaped("role")}) + length({escaped("text")})) AS BIGINT) AS formatted_chars
FROM rows_ GROUP BY conv_id"""
