"""Decontamination on long texts: windows in parts, fingerprints in slices of bits."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm import decontaminate
from lakemart.llm.textblocks import blocks


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=30), st.integers(1, 12), st.integers(0, 8), st.integers(1, 40))
def test_window_starts_match_every_start(hits, span, more, words):
    length, hi = span + more, 320
    old, decontaminate.WINDOWS = decontaminate.WINDOWS, words
    try:
        parts = list(decontaminate.window_starts(hits, 0, hi, span, length))
    finally:
        decontaminate.WINDOWS = old
    want = [s for s in range(hi - length + 1) if any(s <= p < s + span for p in hits)]
    assert [x for p in parts for x in p.tolist()] == want
    assert all(p[-1] - p[0] < words for p in parts)


def test_fingerprints_in_slices_of_bits():
    rng = np.random.default_rng(1)
    sh = rng.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(3)
    weight = rng.integers(1, 20, 500)
    lo = np.arange(0, 400)
    hi = lo + 100
    want = []
    for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
        print_ = 0
        for bit in range(64):
            total = sum(int(w) if int(x) >> bit & 1 else -int(w) for x, w in zip(sh[a:b], weight[a:b], strict=True))
            print_ |= (total > 0) << bit
        want.append(print_)
    old = decontaminate.SUMS
    for size in (old, 500 * 7, 1):
        decontaminate.SUMS = size
        try:
            assert decontaminate._fingerprints(sh, weight, lo, hi).tolist() == want
        finally:
            decontaminate.SUMS = old


def test_a_long_text_full_of_passages_takes_bounded_memory():
    rng = random.Random(2)
    words = [f"word{i}" for i in range(4000)]
    items = [(i, " ".join(rng.choices(words, k=60))) for i in range(20)]
    text = " ".join(rng.choice(items)[1] if rng.random() < 0.5 else " ".join(rng.choices(words, k=60)) for _ in range(4000))
    block = next(blocks(pa.array([text]), lower=True))
    known = decontaminate.Items(items, 5)
    tracemalloc.start()
    found = list(decontaminate.scan(block, known, 0.8))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {f[1] for f in found} == set(range(20)) and all(f[2] == 1.0 for f in found)
    for _, item, _, first, last in found:
        assert " ".join(text.split(" ")[first:last + 1]) == items[item][1]
    assert peak < 150 << 20, peak
