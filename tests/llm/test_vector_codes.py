"""Vector codes against k-means in plain Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.llm import vector_codes
from lakemart.llm.vector_codes import Bounds, assign, drifts, next_width

VECTORS = "vec_id long, embedding array<float>, label int, own int, used string, v int, of int"


def _plain(rows, parts=4, entries=256, rounds=4):
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    least = {}
    for i, v, _ in kept:
        if i is not None and (i not in least or v < least[i]):
            least[i] = v
    first = [least[i] for i in sorted(least)[:entries]]
    d = len(kept[0][1]) // parts if kept else 0
    cut = lambda v: [v[p * d:(p + 1) * d] for p in range(parts)]
    books = [[cut(v)[p] for v in first] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), j) for j, e in enumerate(books[p]))

    for _ in range(rounds):
        got = [[nearest(p, x)[1] for p, x in enumerate(cut(v))] for _, v, _ in kept]
        new = []
        for p in range(parts):
            of = {}
            for g, (_, v, _) in zip(got, kept, strict=True):
                of.setdefault(g[p], []).append(cut(v)[p])
            new.append([[sum(c) // len(c) for c in zip(*of[j], strict=True)] if j in of else e for j, e in enumerate(books[p])])
        books = new
    out = []
    for i, v, label in kept:
        near = [nearest(p, x) for p, x in enumerate(cut(v))]
        out.append([i, "".join(f"{j:02x}" for _, j in near), sum(e for e, _ in near), label])
    total = {}
    for r in out:
        total[r[3]] = total.get(r[3], 0) + r[2]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, total[label], sha) for i, c, e, label in out), key=str)


def _coded(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, label, 1, "u", 2, 3) for i, v, label in rows], VECTORS).repartition(3)
    codes = vector_codes.encode_vectors(frame, **options)
    got = vector_codes.with_label_error(codes.rows).select("vec_id", F.lower(F.hex("code")), "error", "label_error").collect()
    return codes, sorted(((*r, codes.books_sha256()) for r in got), key=str)


def _vectors(n, dims, seed, spread=1.0, step=0.0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        v = [rng.gauss(0, spread) for _ in range(dims)]
        out.append((i, [float(np.float32(round(x / step) * step if step else x)) for x in v], rng.choice([0, 1, 2, None])))
    return out


def test_codes_match_plain_integers(spark):
    rows = _vectors(300, 16, 1)
    assert _coded(spark, rows, entries=40)[1] == _plain(rows, entries=40)


def test_ties_repeats_and_bad_components(spark):
    rows = _vectors(200, 8, 2, 0.003, 0.002)  # few distinct integers: many equal distances and equal entries
    rows += [(i, v, label) for i, v, label in rows[:60]] + [(3, rows[9][1], 1), (None, rows[5][1], 2), (None, rows[5][1], None)]
    rows += [(-5, None, 0), (-4, [None] + rows[0][1][1:], 0), (-3, [math.nan] + rows[0][1][1:], 0), (-2, [math.inf] + rows[0][1][1:], 0),
             (-1, rows[0][1][:-1] + [-math.inf], 0)]
    for closest in (1, 2, 5, 40):
        assert _coded(spark, rows, entries=24, closest=closest)[1] == _plain(rows, entries=24)


def test_fewer_rows_than_entries_and_none(spark):
    rows = _vectors(5, 4, 3)
    assert _coded(spark, rows)[1] == _plain(rows)
    assert _coded(spark, rows[:1])[1] == _plain(rows[:1])
    codes, got = _coded(spark, [])
    assert got == [] and codes.books_sha256() == hashlib.sha256(b"").hexdigest()
    assert _coded(spark, [(1, None, 0)])[1] == []
    assert _coded(spark, [(1, [], 0), (2, [], 1)])[1] == _plain([(1, [], 0), (2, [], 1)])


def test_lengths_that_do_not_fit_are_refused(spark):
    for rows in ([(1, [1.0] * 6, 0)], [(1, [1.0] * 4, 0), (2, [1.0] * 8, 0)], [(1, [1e8] * 4, 0)]):
        with pytest.raises(Exception, match="equal parts|components|too large"):
            _coded(spark, rows)


def test_large_components_use_whole_numbers(spark):
    rows = [(i, [x * 3e5 for x in v], label) for i, v, label in _vectors(60, 8, 4)]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    assert _coded(spark, rows, entries=12)[1] == _plain(rows, entries=12)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 30), st.integers(1, 9), st.sampled_from([2, 30, 2000]))
def test_bounds_stay_true_while_entries_move(seed, k, b, spread):
    rng = np.random.default_rng(seed)
    x = rng.integers(-spread, spread, (50, 3))
    entries = rng.integers(-spread, spread, (k, 3))
    bounds = Bounds.of(vector_codes.distances(x, entries), min(b, k - 1))
    for _ in range(4):
        after = entries + rng.integers(-1 - spread // 10, 2 + spread // 10, entries.shape)
        moved = bounds.moved(drifts(entries, after), b)
        d = ((x[:, None] - after) ** 2).sum(2)
        bounds, dist, _ = assign(x, after, moved)
        assert (bounds.own == d.argmin(1)).all() and (dist == d.min(1)).all()
        root = np.sqrt(d)
        assert (bounds.low <= np.take_along_axis(root, bounds.closest, 1)).all()
        assert (np.sort(np.concatenate([bounds.own[:, None], bounds.closest], 1), 1)[:, 1:]
                > np.sort(np.concatenate([bounds.own[:, None], bounds.closest], 1), 1)[:, :-1]).all()
        rest = root.copy()
        np.put_along_axis(rest, np.concatenate([bounds.own[:, None], bounds.closest], 1), np.inf, 1)
        assert (bounds.outer <= rest.min(1)).all()
        entries = after


def test_width_follows_use():
    used = np.zeros(12, int)
    used[1], used[2] = 900, 100
    assert next_width(used, 10) == 2
    used[7] = 100
    assert next_width(used, 10) == 7
    assert next_width(np.zeros(12, int), 10) == 10
