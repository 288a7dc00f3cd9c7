"""Byte-level BPE by prefix dynamic programming (operator 5).

For every byte prefix of a piece exactly one token can come last in the
prefix's encoding.  ``Prefixes`` stores that token for each prefix: a token t
ends prefix i if t is the bytes up to i, and the last token of the prefix
before t followed by t is left as it is by the merges.  Encodings are read
back from the end.  Appending bytes goes on from the stored prefixes and gives
the same ids as encoding anew; an edit keeps all prefixes before it.

Whether two neighbouring tokens stay apart follows from the parts that lie at
their border while the merges go on, and is remembered.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache
from sys import getsizeof

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.textblocks import keep, map_batches

#: Bytes of each memory of a process, by the sizes that CPython gives its objects, before it is emptied.  Tasks of this
#: operator hand them on; another operator's task empties them all.
WORDS_BYTES, HEADS_BYTES, APART_BYTES = 112 << 20, 16 << 20, 48 << 20
#: A dict's slot and entry, and a small int.
_SLOT, _INT = 104, 32
#: Pieces share the last tokens of prefixes of so many bytes.
HEAD = 6
#: Pieces of so many bytes are encoded with plain lists.
SHORT = 64


class Vocabulary:
    """Token ranks, which tokens can stand side by side, and last tokens of prefixes seen."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        #: by four last bytes: the lengths of the tokens that end so, longest first
        self.lengths: dict[bytes, tuple[int, ...]] = {}
        ends: dict[bytes, set[int]] = {}
        for t in ranks:
            if len(t) >= 4:
                ends.setdefault(t[-4:], {1, 2, 3}).add(len(t))
        for end, found in ends.items():
            self.lengths[end] = tuple(sorted(found, reverse=True))
        self.packed = {r: r.to_bytes(4, "little") for r in self.tokens}
        #: the last tokens of all prefixes of the pieces' first bytes seen
        self.heads: dict[bytes, list[int]] = {}
        self._apart: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._edges: dict[tuple[int, int], list[tuple[bytes, int]]] = {}

    def forget(self) -> None:
        """Empty the memories; what follows from the ranks alone stays."""
        self.heads.clear()
        self._apart.clear()
        self._halves.clear()
        self._edges.clear()

    def merge(self, piece: bytes, stop: int = 1) -> list[int]:
        """The piece's ids by merging the lowest-ranked neighbours first, down to ``stop`` parts."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > stop:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 40))
            joined = parts[best] + parts[best + 1]
            if joined not in self.ranks:
                break
            parts[best:best + 2] = [joined]
        return [self.ranks[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that are merged last to make this one; (token, token) for a byte, None if merges don't make it."""
        if token not in self._halves:
            data = self.tokens[token]
            parts = self.merge(data, 2) if len(data) > 1 else [token, token]
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The parts that lie at a token's left (0) or right (1) edge while it is made, each with the rank of the merge that ends it."""
        known = self._edges.get((token, side))
        if known is None:
            known, t, ends = [], token, 1 << 40
            while True:
                known.append((self.tokens[t], ends))
                if len(self.tokens[t]) == 1:
                    break
                ends, t = t, self.halves(t)[side]
            self._edges[token, side] = known
        return known

    def apart(self, left: int, right: int) -> bool:
        """Whether the bytes of both tokens together encode as these two tokens.

        They don't if two parts at the border would be merged while both are
        there.  Of equal merges the one further left comes first.  A right
        token that merges don't make stands beside none.
        """
        key = left << 20 | right
        known = self._apart.get(key)
        if known is None:
            if len(self._apart) >= APART_BYTES // (_SLOT + _INT):
                self._apart.clear()
            get, known = self.ranks.get, self.halves(right) is not None
            for b, b_ends in self._edge(right, 0) if known else ():
                for a, a_ends in self._edge(left, 1):
                    rank = get(a + b)
                    if rank is not None and rank < a_ends and rank <= b_ends:
                        known = False
                        break
                if not known:
                    break
            self._apart[key] = known
        return known

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """``last`` has the last tokens of the encodings of data's prefixes so far; those of the longer ones are added."""
        get, apart, lengths = self.ranks.get, self._apart, self.lengths.get
        for i in range(len(last), len(data) + 1):
            for n in lengths(data[i - 4:i], (3, 2, 1)) if i >= 4 else (3, 2, 1):
                if n < i:
                    t = get(data[i - n:i])
                    if t is not None:
                        left = last[i - n]
                        known = apart.get(left << 20 | t)
                        if known or (known is None and self.apart(left, t)):
                            last.append(t)
                            break
                elif n == i:
                    t = get(data[:i])
                    if t is not None and self.halves(t) is not None:
                        last.append(t)
                        break
            else:
                raise ValueError("a byte of the text is not in the vocabulary")
        return last

    def encode_short(self, piece: bytes) -> list[int]:
        """Ids of a piece, going on from the prefixes of its first bytes, which many pieces share."""
        head = piece[:HEAD]
        known = self.heads.get(head)
        if known is None:
            if len(self.heads) >= HEADS_BYTES // (_SLOT + 33 + HEAD + 88 + HEAD * (8 + _INT)):
                self.heads.clear()
            known = self.heads[head] = self.extend(head, [-1])
        last = self.extend(piece, known.copy()) if len(piece) > HEAD else known
        out, i, tokens = [], len(piece), self.tokens
        while i:
            t = last[i]
            out.append(t)
            i -= len(tokens[t])
        return out[::-1]


class Prefixes:
    """The last token of each byte prefix of a piece."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(piece)

    def append(self, more: bytes) -> Prefixes:
        """Go on from the stored prefixes."""
        self.data += more
        self.vocabulary.extend(self.data, self.last)
        return self

    def replace(self, start: int, end: int, by: bytes) -> Prefixes:
        """Put ``by`` in place of the bytes start..end; prefixes before start are kept."""
        rest = by + self.data[end:]
        self.data, self.last = self.data[:start], self.last[:start + 1]
        return self.append(rest)

    def ids(self) -> list[int]:
        out, i = [], len(self.data)
        while i:
            out.append(self.last[i])
            i -= len(self.vocabulary.tokens[self.last[i]])
        return out[::-1]


class Encoder(dict):
    """Texts to packed ids (little-endian, 32 bits); remembers words by their text.

    A text can be cut at any space between two visible characters: no match of
    the pattern ends with white space that follows something visible, so each
    such space starts a match and what comes before doesn't depend on it.
    """

    _CUT = re.compile(r"(?<=\S) (?=\S)")
    _UNEVEN = re.compile(r" \s|\s(?: |\Z)|\A\s")  # some space isn't such a cut
    _TAIL = frozenset(".,;:!?")  # after letters each is a match of its own

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self._older: dict[str, bytes] = {}
        self._bytes = 0
        self.vocabulary, self._pattern = Vocabulary(ranks), regex.compile(pattern)

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern; a piece that is a token is that token."""
        own = self.vocabulary.ranks.get(piece)
        if own is not None:
            return [own]
        return self.vocabulary.encode_short(piece) if len(piece) <= SHORT else Prefixes(self.vocabulary, piece).ids()

    def _pack_piece(self, piece: bytes) -> bytes:
        return b"".join(map(self.vocabulary.packed.__getitem__, self.encode_piece(piece)))

    def pack(self, text: str) -> bytes:
        return b"".join([self._pack_piece(m.group().encode()) for m in self._pattern.finditer(text)])

    def __missing__(self, word: str) -> bytes:
        """Packed ids of a space and a word; words met again stay when the memory is renewed."""
        packed = self._older.pop(word, None)
        if packed is None:
            if word.isalpha():
                packed = self._pack_piece(b" " + word.encode())  # letters are one match
            elif word[-1] in self._TAIL and word[:-1].isalpha():
                packed = self[word[:-1]] + self._pack_piece(word[-1].encode())
            else:
                packed = self.pack(" " + word)
        if len(word) <= 64:
            if self._bytes >= WORDS_BYTES // 2:
                self._older = dict(self)
                self.clear()
                self._bytes = 0
            self[word] = packed
            self._bytes += getsizeof(word) + getsizeof(packed) + _SLOT
        return packed

    def forget(self) -> None:
        """Empty the memories."""
        self.clear()
        self._older.clear()
        self._bytes = 0
        self.vocabulary.forget()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        words = self._CUT.split(text) if self._UNEVEN.search(text) else text.split(" ")
        return b"".join([self.pack(words[0]), *map(self.__getitem__, words[1:])])

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks from a file of lines "base64-token rank"."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in data.splitlines() if line.strip())}


@lru_cache(maxsize=2)
def _encoder(sent, pattern: str) -> Encoder:
    return Encoder(read_ranks(sent), pattern)


def encode_documents(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     keep_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, and ids if asked for) for each row of ``docs``.

    ``ranks``: the contents of a rank file.  Nulls: a null text counts as
    empty and has no ids; a row without id is encoded all the same.  Repeated
    rows give a row each; other columns are left aside; an empty table gives no
    rows.  Texts are taken whole; special tokens in a text are ordinary text.
    """
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    def rows(batch):
        encoder = _encoder(sent.value, pattern)
        keep("bpe", encoder.forget)
        n, ids_sha, own_sha, ids = [], [], [], []
        for text in batch.column("text").to_pylist():
            packed = encoder.encode(text or "")
            n.append(len(packed) // 4)
            ids_sha.append(hashlib.sha256(packed).hexdigest())
            own_sha.append(hashlib.sha256(encoder.decode(packed)).hexdigest())
            if keep_ids:
                ids.append(np.frombuffer(packed, "<u4").astype(np.int32))
        yield {"doc_id": batch.column("doc_id"), "n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": own_sha, "ids": ids}

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(texts, rows, schema + (", ids array<int>" if keep_ids else ""), memory="bpe")
