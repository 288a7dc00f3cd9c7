"""Chat formatting against plain Python: whole conversations rendered, encoded and hashed in one go."""

import base64
import hashlib
import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm import chat_format
from lakemart.llm.chat_format import IGNORED, Template, mask_of
from lakemart.llm.queries import tokenizer

ROWS = "conv_id long, turn long, role string, text string, tie long, seq string, ids int"
HOSTILE = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>x</s>", "\\", "\\\\</s>", "<|te\\xt|>", "<|text|", "|>", "", " \n",
           "É漢字 <s>", "a" * 300]


def _sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def _want(rows, template=Template()):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    out = set()
    for conv, own in by.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        turns = [(r[2] or "", r[3] or "") for r in own]
        loss = "".join(t for r, t in turns if r == "assistant")
        formatted = "".join("".join(template.render(r, t)) for r, t in turns)
        out.add((conv, len(own), _sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), _sha(loss), len(formatted)))
    return out


def _frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, 1, "s", 0) for r in rows], ROWS).repartition(parts)


def _back(spark, rows):
    return chat_format.read_back(chat_format.format_conversations(_frame(spark, rows), *tokenizer()))


def _many():
    rng = random.Random(3)
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, turn, ("system", "user", "assistant")[turn and 1 + turn % 2],
                         rng.choice(HOSTILE) + " ".join(rng.choice("so the É漢 x1 end. \n".split(" ")) for _ in range(rng.randint(0, 60)))))
    return rows + [(900, i, "assistant" if i % 2 else "user", f"hot {i} " + "w " * (i % 50)) for i in range(600)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("<|turnex>/s[INST]\\ a"), max_size=30), max_size=4), st.sampled_from(HOSTILE))
def test_template_is_reversible(texts, more):
    t = Template()
    turns = [(x, more + x) for x in texts]
    rendered = "".join("".join(t.render(r, x)) for r, x in turns)
    assert t.parse(rendered) == turns
    for _, x in turns:
        assert t.unescape(t.escape(x)) == x and not any(c in t.escape(x) for c in (*t.controls, *t.reserved))
    joined = "".join(t.escape(x) for _, x in turns)
    assert t.unescape(joined) == "".join(x for _, x in turns)


def test_template_refuses_strings_that_overlap():
    for bad in ({"end": "s>"[::-1] * 2 + "<"}, {"end": "<|turn|>"}, {"end": "<\\x"}, {"reserved": (">a<",)}, {"end": "x"}):
        with pytest.raises(ValueError):
            Template(**bad)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 5), max_size=20), st.lists(st.integers(0, 60), max_size=8))
def test_mask_matches_every_token_against_every_span(lengths, edges):
    ends = np.cumsum(np.array(lengths, np.int64))
    cuts = sorted(set(edges))
    spans = list(zip(cuts[::2], cuts[1::2], strict=False))
    want = [any(s < e and a < b for a, b in spans if max(s, a) < min(e, b)) for s, e in zip([0, *ends[:-1]], ends, strict=False)]
    assert mask_of(ends, spans).tolist() == want


def test_read_back_matches_plain_python(spark):
    rows = _many()
    got = _back(spark, rows)
    assert {tuple(r) for r in got.collect()} == _want(rows)


def test_small_pieces_and_held_bytes_give_the_same(spark):
    rows = _many()
    pieces = chat_format.format_conversations(_frame(spark, rows), *tokenizer(), piece_chars=40)
    assert pieces.count() > len({r[0] for r in rows})
    for hold in (0, 100, 1 << 20):
        assert {tuple(r) for r in chat_format.read_back(pieces, hold_bytes=hold).collect()} == _want(rows)


def test_hot_conversation_is_split_over_tasks_and_encodes_as_one_text(spark):
    from pyspark.sql import functions as F

    rows = _many()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = chat_format.format_conversations(_frame(spark, rows), *tokenizer())
        assert pieces.where("conv_id = 900").select(F.spark_partition_id()).distinct().count() > 1
        assert {tuple(r) for r in chat_format.read_back(pieces).collect()} == _want(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    data, pattern = tokenizer()
    ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, data.splitlines())}
    t, top = Template(), max(ranks.values()) + 1
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={c: top + i for i, c in enumerate(t.controls)})
    by = {}
    for p in sorted(pieces.collect(), key=lambda p: (p.conv_id, p.turn, p.tie, p.seq)):
        by.setdefault(p.conv_id, []).append(p)
    for conv, parts in by.items():
        whole = "".join("".join(t.render(r[2], r[3])) for r in sorted(r for r in rows if r[0] == conv))
        assert "".join(p.formatted for p in parts) == whole
        assert [i for p in parts for i in p.ids] == own.encode(whole, allowed_special="all")
        for p in parts:
            assert own.decode(p.ids) == p.formatted and p.ends[-1] == len(p.formatted.encode())
            assert all(x in (i, IGNORED) for i, x in zip(p.ids, p.labels, strict=True))


def test_long_text_is_encoded_in_slices(monkeypatch):
    data, pattern = tokenizer()
    encoder = chat_format.ChatEncoder(chat_format.read_ranks(data), pattern, Template())
    rng = random.Random(1)
    parts = ["one", "É漢", "</s>", "  two", "\n", "x" * 90, "<|turn|>", "<|text|> ", "end."]
    text = " ".join(rng.choice(parts) for _ in range(4000))
    ids, ends = encoder.encode(text)
    monkeypatch.setattr(chat_format, "SLICE_CHARS", 1000)
    again, ends_again = encoder.encode(text)
    assert (ids == again).all() and (ends == ends_again).all() and ends[-1] == len(text.encode())


def test_edge_rows(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", None), (1, None, "user", "first"), (1, 0, None, None),
            (2, 0, "assistant", ""), (3, 5, "assistant", "x"), (3, 5, "assistant", "x"), (3, 5, "assistant", "x"),
            (4, 0, "tool", "</s>"), (5, 0, "assistant", "漢" * 400_000), (6, -3, "user\nx", "neg")]
    assert {tuple(r) for r in _back(spark, rows).collect()} == _want(rows)
    tied = [(1, 0, "user", "b"), (1, 0, "assistant", "a")]
    assert _back(spark, tied).collect() == _back(spark, tied[::-1]).collect()
    assert _back(spark, []).collect() == []
