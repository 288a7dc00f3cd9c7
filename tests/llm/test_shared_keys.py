"""The n-gram join's keys: shuffled once, those of a single set left out where they arrive."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from lakemart.llm import ngram_join


def _rows(batches):
    return [tuple(x) for b in batches for x in zip(*(c.to_pylist() for c in b.columns))]


def test_shared_equals_brute_force_however_the_rows_are_cut():
    rng = random.Random(5)
    for trial in range(300):
        rows = sorted((rng.randrange(6), rng.choice([-9, -2, 0, 3, 8])) for _ in range(rng.randrange(0, 30)))
        want = {}
        for key, sid in rows:
            want.setdefault(key, set()).add(sid)
        want = sorted((k, s, min(sids)) for k, sids in want.items() if len(sids) > 1 for s in sids)
        cuts = sorted(rng.randrange(0, len(rows) + 1) for _ in range(rng.randrange(0, 8)))
        batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[a:b]], pa.int64()) for i in (0, 1)], ["key", "set_id"])
                   for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        assert _rows(ngram_join._shared(batches)) == want, (trial, rows, cuts)


def test_keys_are_shuffled_once_and_same_groups_compared_once(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in rng.integers(0, 400, 120)]
    rows = [(i, " ".join([*words[:-1], f"tail{i}"])) for i in range(6)]  # near copies: most ranges alike
    rows += [(10 + i, " ".join(f"x{i}y{j}" for j in range(60))) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plans, asked = {}, {}
    store_at, closure = ngram_join.stored_at, ngram_join.connected_components

    def spied(df, sp, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return store_at(df, sp, name)

    def components(edges, sp):
        asked.setdefault("ties", edges.count())
        return closure(edges, sp)

    monkeypatch.setattr(ngram_join, "stored_at", spied)
    monkeypatch.setattr(ngram_join, "connected_components", components)
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_components(docs).collect()}
    assert got == {**{i: 0 for i in range(6)}, **{10 + i: 10 + i for i in range(4)}}
    assert plans["common-keys"].count("Exchange") == 1, plans["common-keys"]
    assert asked["ties"] < 20, asked  # 5 ties for a group; not 5 for each key that the group shares
