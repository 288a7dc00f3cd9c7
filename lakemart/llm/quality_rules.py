"""Line-first quality rules (operator 3).

Each line with a word is judged by itself; failing lines are removed, and a
document that loses too large a share of its words is rejected.  A line fails
as navigation (separators between its words), as symbols (marks stuck to most
words), as shouting (nearly all capitals), as unpunctuated (a long line
without any sentence or clause mark of any script), or as boilerplate (a short line with a
phrase of a site's furniture).  Beside that stand the counts and limits for
whole documents.

Counts come from byte tables and sorted hashes over blocks of texts, so no
object is made per word.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.textblocks import (SPACE_WORD, U, Block, blocks, map_batches, mix, packed, row_of, shingles, unpacked,
                                     with_field)

#: Limits for whole documents.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
#: Share of a document's words in failing lines from which it is rejected.
MAX_LOST = 0.3
#: Phrases (lower case) of a site's furniture; they fail a line of at most BOILERPLATE_WORDS words.
BOILERPLATE = ("cookie policy", "privacy policy", "terms of service", "terms of use", "enable javascript",
               "javascript is disabled", "accept cookies", "subscribe to our newsletter", "share this article",
               "skip to content", "log in to comment")
BOILERPLATE_WORDS = 15

_SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, n_bad_lines long, lost_words long, kept boolean")


def _table(values) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(values)] = True
    return t


_SYMBOL, _PIPE, _MARK = _table(SYMBOLS), _table(b"|"), _table(b".,;:!?")
#: Sentence and clause marks beyond ASCII (Unicode's Terminal_Punctuation without marks that stand between all words,
#: and the Armenian, ellipsis and vertical marks).
_FAR_MARK = re.compile(
    "[\u037e\u0387\u055c-\u055e\u0589\u05c3\u060c\u061b\u061d-\u061f\u06d4\u0700-\u070a\u070c\u07f8\u07f9\u0830-\u0835\u0837-\u083e\u085e\u0964\u0965"
    "\u0df4\u0e5a\u0e5b\u0f08\u0f0d-\u0f12\u104a\u104b\u1362-\u1368\u166e\u16eb-\u16ed\u1735\u1736\u17d4-\u17d6\u17da\u1801-\u1805\u1808\u1809"
    "\u1944\u1945\u1a1e\u1aa8-\u1aab\u1b4e\u1b4f\u1b5a\u1b5b\u1b5d-\u1b5f\u1b7d-\u1b7f\u1c3b-\u1c3f\u1c7e\u1c7f\u2024-\u2026\u203c\u203d\u2047-\u2049\u204f"
    "\u22ef\u2cf9-\u2cfb\u2cfe\u2e2e\u2e32\u2e34\u2e35\u2e3c\u2e41\u2e49\u2e4c\u2e4e\u2e4f\u2e53\u2e54\u3001\u3002\ua4fe\ua4ff\ua60d-\ua60f\ua6f3-\ua6f7"
    "\ua876\ua877\ua8ce\ua8cf\ua92f\ua9c7-\ua9c9\uaa5d-\uaa5f\uaadf\uaaf0\uaaf1\uabeb\ufe10-\ufe16\ufe19\ufe50-\ufe52\ufe54-\ufe57"
    "\uff01\uff0c\uff0e\uff1a\uff1b\uff1f\uff61\uff64"
    "\U0001039f\U000103d0\U00010857\U0001091f\U00010a56\U00010a57\U00010af0-\U00010af5\U00010b3a-\U00010b3f\U00010b99-\U00010b9c"
    "\U00010f55-\U00010f59\U00010f86-\U00010f89\U00011047-\U0001104d\U000110be-\U000110c1\U00011141-\U00011143\U000111c5\U000111c6\U000111cd"
    "\U000111de\U000111df\U00011238-\U0001123c\U000112a9\U000113d4\U000113d5\U0001144b-\U0001144d\U0001145a\U0001145b\U000115c2-\U000115c5"
    "\U000115c9-\U000115d7\U00011641\U00011642\U0001173c-\U0001173e\U00011944\U00011946\U00011a42\U00011a43\U00011a9b\U00011a9c\U00011aa1\U00011aa2"
    "\U00011c41-\U00011c43\U00011c71\U00011ef7\U00011ef8\U00011f43\U00011f44\U00012470-\U00012474\U00016a6e\U00016a6f\U00016af5\U00016b37-\U00016b39"
    "\U00016b44\U00016d6e\U00016d6f\U00016e97\U00016e98\U00016e9a\U0001bc9f\U0001da87-\U0001da8a]")
_UPPER, _LOWERS, _BEYOND = _table(range(65, 91)), _table(range(97, 123)), _table(range(128, 256))
_HEAD = ~_table(range(0x80, 0xC0))  # bytes that begin a code point


def _running(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _repeats(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items by (row, key): whether an equal one is in the same row, and whether one stands before."""
    own = mix(key ^ mix(row.astype(U) + U(1)))
    order = np.argsort(own, kind="stable")
    same = np.zeros(len(own) + 1, bool)
    same[1:-1] = own[order[1:]] == own[order[:-1]] if len(own) else False
    after, twice = np.zeros(len(own), bool), np.zeros(len(own), bool)
    after[order] = same[:-1]
    twice[order] = same[:-1] | same[1:]
    return twice, after


def bad_lines(block: Block) -> tuple[np.ndarray, ...]:
    """(row, number, failed, words, repeats an earlier line) of each line with a word, and the words' places."""
    data = block.data
    start, end, first = block.lines()
    ws, we, wfirst = block.words(SPACE_WORD)
    words = np.searchsorted(ws, end) - np.searchsorted(ws, start)
    row = row_of(first)
    number = np.arange(len(start)) - first[row]
    used = words > 0
    start, end, words, row, number = start[used], end[used], words[used], row[used], number[used]

    def count(table):
        c = _running(table[data])
        return c[end] - c[start]

    symbols, pipes, marks = count(_SYMBOL), count(_PIPE), count(_MARK)
    upper, lower, beyond = count(_UPPER), count(_LOWERS), count(_BEYOND)
    failed = (pipes >= 3) & (pipes * 5 >= words)
    failed |= (symbols - pipes >= 3) & (2 * (symbols - pipes) >= words)
    failed |= (words >= 4) & (upper >= 12) & (10 * upper >= 7 * (upper + lower + beyond // 2))
    bare = (words >= 15) & (marks == 0)
    for i in np.flatnonzero(bare & (beyond > 0)).tolist():
        bare[i] = not _FAR_MARK.search(data[start[i]:end[i]].tobytes().decode("utf-8", "replace"))
    failed |= bare
    low = bytes(data).lower()
    for phrase in BOILERPLATE:
        p = phrase.encode()
        at = low.find(p)
        while at >= 0:
            i = int(np.searchsorted(start, at, "right")) - 1
            if i >= 0 and at + len(p) <= end[i] and words[i] <= BOILERPLATE_WORDS:
                failed[i] = True
            at = low.find(p, at + 1)
    again = _repeats(block.span_hash(start, end), row)[1] if len(start) else np.zeros(0, bool)
    return row, number, failed, words, again, (ws, we, wfirst)


def _measure(max_lost: float):
    def rows(batch):
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        mask = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        import pyarrow as pa

        for block in blocks(batch.column("text")):
            n = block.rows
            row, _, failed, words, again, (ws, we, wfirst) = bad_lines(block)
            n_words = np.diff(wfirst)
            heads = _running(_HEAD[block.data])
            chars = _running(np.zeros(0)) if not len(ws) else np.concatenate([[0], np.cumsum(heads[we] - heads[ws])])
            symbols = _running(_SYMBOL[block.data])
            wh = block.span_hash(ws, we)
            sh, whole = shingles(wh, wfirst, 3)
            wrow = row_of(wfirst)
            at = np.flatnonzero(whole)
            twice = at[_repeats(sh[at], wrow[at])[0]] if len(at) else at
            covered = np.zeros(len(wh), bool)
            for j in range(3):
                covered[twice + j] = True
            inside = _running(covered)
            repeat = inside[wfirst[1:]] - inside[wfirst[:-1]]
            lost = np.bincount(row[failed], words[failed], n).astype(np.int64)
            base = (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n_words)
            here = slice(block.first_row, block.first_row + n)
            yield {"doc_id": pa.array(ids[here], pa.int64(), mask=mask[here]), "n_words": n_words,
                   "word_chars": chars[wfirst[1:]] - chars[wfirst[:-1]],
                   "n_symbols": symbols[block.offsets[1:]] - symbols[block.offsets[:-1]],
                   "n_dup_lines": np.bincount(row[again], minlength=n), "n_repeat_words": repeat,
                   "base_failed": base, "n_bad_lines": np.bincount(row[failed], minlength=n), "lost_words": lost,
                   "kept": ~base & (lost <= max_lost * n_words)}

    return rows


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """Counts and verdict for each row of ``docs``.

    Nulls: a null text has no words, lines or symbols and is rejected (too few
    words), as is an empty one; a row without id is judged like any other.
    Repeated rows give a row each; other columns are left aside; an empty
    table gives no rows.  Texts are taken whole.  Sentence and clause marks of
    all scripts count; a script written without any (Thai) has none to count.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(texts, _measure(max_lost), _SCHEMA)


def _clean(text_col: str, max_lost: float):
    import pyarrow as pa

    def rows(batch):
        row = batch.column("row")
        texts = row.field(text_col)
        own = pa.RecordBatch.from_arrays([pa.nulls(len(row), pa.int64()), texts], names=["doc_id", "text"])
        for block, verdict in zip(blocks(texts), _measure(max_lost)(own)):
            at = np.flatnonzero(verdict["kept"])
            if not len(at):
                continue
            of, number, failed, _, _, _ = bad_lines(block)
            drop: dict[int, set[int]] = {}
            for r, i in zip(of[failed].tolist(), number[failed].tolist()):
                drop.setdefault(r, set()).add(i)
            out = []
            for r in at.tolist():
                text, gone = texts[block.first_row + r].as_py(), drop.get(r)
                out.append(text if not gone else "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone))
            yield {"row": with_field(row.take(pa.array(at + block.first_row)), text_col, out)}

    return rows


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """The rows of ``docs`` that stay, without their failing lines; all columns as before.

    Nulls: null and empty texts have too few words and go; a row without id is
    judged like any other.  Repeated rows stay or go together.  Texts are whole,
    whatever their length.  Other columns, whatever their names, are kept as they
    are.  An empty table gives no rows.
    """
    rows = packed(docs, text_col)
    return unpacked(map_batches(rows, _clean(text_col, max_lost), rows.schema), docs.columns)
