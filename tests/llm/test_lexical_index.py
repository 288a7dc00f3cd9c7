"""Ranked search against scores of every document in plain Python."""

import collections
import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from lakemart.llm import lexical_index
from lakemart.llm.lexical_index import _others

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, m long, h string, n int, df int"
ITEMS = "item_id long, text string, rank int, doc_id long, key string"


def _terms(text):
    return re.findall(TERM, (text or "").translate(LOWER))


def _plain(docs, items, k=20):
    bags = [(i, collections.Counter(_terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, words = len(bags), sum(n for _, _, n in bags)
    df = collections.Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in set(items):
        own = _terms(text)
        scored = []
        for i, b, n in bags:
            m = 100 - 25 + (25 * n * n_docs) // words
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * b[t]) // (1000 * b[t] + 12 * m))
                    for t in own if t in b)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def _docs(rng, n=300):
    words = [f"w{i}" for i in range(80)] + ["É", "漢字", "The", "x_y", "it's", "A1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([1, 3, 8, 8, 8, 20, 60])))) for i in range(n)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)] + [docs[3]] * 3 + [(None, docs[9][1]), (None, docs[9][1])]
    docs += [(2000, None), (2001, ""), (2002, " ,. \n"), (2003, " ".join(rng.choices(words, weights, k=5000)))]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 2, 6, 15])))) for i in range(25)]
    items += [(3, items[3][1]), (90, None), (91, ""), (92, "unseen words"), (None, "w1 w2"), (93, "w5 W5 w5"), (94, docs[-1][1])]
    return docs, items


def _index(spark, docs, **options):
    return lexical_index.build_index(spark.createDataFrame([(*d, 1, "h", 2, 3) for d in docs], DOCS).repartition(4), **options)


def _found(spark, index, items, **options):
    frame = spark.createDataFrame([(*x, 1, 2, "k") for x in items], ITEMS)
    return sorted(map(tuple, lexical_index.search(index, frame, **options).collect()), key=str)


def test_search_matches_plain_python(spark):
    docs, items = _docs(random.Random(1))
    index = _index(spark, docs, block_pairs=200)
    want = _plain(docs, items)
    assert _found(spark, index, items) == want
    assert _found(spark, index, items, query_pairs=10, visit_bytes=1000) == want
    assert _found(spark, index, items, k=3) == _plain(docs, items, 3)
    # strata hold one m each, blocks are bounded, postings go by frequency
    pairs = index.blocks.select("m", F.size("docs").alias("n"), F.size("doc_ids").alias("d"), "run_tf", "term_runs").collect()
    assert all(r.n <= 200 or r.d == 1 for r in pairs) and len(pairs) > len({r.m for r in pairs})
    for r in pairs:
        at = 0
        for runs in r.term_runs:
            assert list(r.run_tf[at:at + runs]) == sorted(set(r.run_tf[at:at + runs]))
            at += runs
    assert _found(spark, _index(spark, docs), items) == want


def test_terms_that_share_a_hash_are_noticed(spark):
    docs, items = _docs(random.Random(2), 60)
    weak = _index(spark, docs, bits=5)
    assert weak.terms.where("other IS NOT NULL").count() > 0
    assert _found(spark, weak, items, k=5) == _plain(docs, items, 5)


def test_other_hash_function_gives_the_same(spark):
    docs, items = _docs(random.Random(3), 60)
    assert _found(spark, _index(spark, docs, seed=1), items) == _plain(docs, items)


def test_others_sees_every_word_that_differs():
    data = np.frombuffer(b"ab abc ab xb", np.uint8)
    start, end = np.array([0, 3, 7, 10]), np.array([2, 6, 9, 12])
    assert _others(data, start, end, np.zeros(4, int)).tolist() == [1, 3]
    assert _others(data, start[:0], end[:0], np.zeros(0, int)).tolist() == []


def test_empty_tables(spark):
    docs, items = _docs(random.Random(4), 20)
    for none in ([], [(1, None), (2, ""), (3, "...")]):
        assert _found(spark, _index(spark, none), items) == []
    index = _index(spark, docs)
    assert _found(spark, index, []) == [] and _found(spark, index, [(1, None), (2, "")]) == []


def test_very_long_text(spark):
    rng = random.Random(5)
    long = " ".join(f"t{rng.randint(0, 60_000)}" for _ in range(300_000))
    docs = [(1, long), (2, "t1 t2 t3"), (3, long + " t1"), (4, "x " * 10)]
    items = [(1, "t1 t2 x"), (2, "t5 t6 t7 t8")]
    assert _found(spark, _index(spark, docs), items) == _plain(docs, items)
