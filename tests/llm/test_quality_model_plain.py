"""The quality classifier's features and FTRL steps against plain Python."""

import math
import random
import re

import numpy as np
import pyarrow as pa

from lakemart.llm import quality_model
from lakemart.llm.quality_model import SLOTS, Ftrl
from lakemart.llm.textblocks import blocks

TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff \t\n\v\f\r]+")


def _texts():
    rng = random.Random(3)
    parts = ["alpha", "Beta", "GAMMA", "A", "x1", "É漢", "...", "!!", "a-b", "the the", "\n", "42"]
    return [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(60)] + ["", None, " \n", "ONE"]


def _hashes(token):
    """The hash that a block gives a span of these bytes."""
    block = next(blocks(pa.array([token.decode()])))
    return int(block.span_hash(np.array([0]), np.array([len(token)]))[0])


def test_features_are_tokens_pairs_and_capitals():
    texts = _texts()
    got = {i: [] for i in range(len(texts))}
    for block in blocks(pa.array(texts)):
        for row, slot in zip(*(a.tolist() for a in quality_model.features(block)), strict=True):
            got[row + block.first_row].append(slot)
    pairs = {}
    for i, text in enumerate(texts):
        tokens = TOKEN.findall((text or "").encode())
        h = [_hashes(t) for t in tokens]
        loud = sum(len(t) > 1 and bool(re.fullmatch(rb"[A-Z]+", t)) for t in tokens)
        same = sum(a == b for a, b in zip(tokens, tokens[1:], strict=False))
        single = [x % SLOTS for x in h]
        rest = sorted(got[i])
        for s in single + [quality_model._SAME] * same + [quality_model._CAPITALS] * loud:
            rest.remove(s)
        differ = [(a, b) for a, b in zip(tokens, tokens[1:], strict=False) if a != b]
        assert len(rest) == len(differ)
        # a pair of tokens has one slot, wherever it stands
        for key in set(differ):
            pairs.setdefault(key, set(rest))
            pairs[key] &= set(rest)
    assert all(len(slots) >= 1 for slots in pairs.values())


def test_ftrl_steps_match_plain_python():
    rng = random.Random(4)
    alpha, beta, l1, l2 = 1.0, 1.0, 1e-4, 1e-4
    model, z, n = Ftrl(alpha, beta, l1, l2), {}, {}

    def weight(i):
        zi = z.get(i, 0.0)
        if abs(zi) <= l1:
            return 0.0
        return -(zi - math.copysign(l1, zi)) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    for _ in range(300):
        slots = rng.sample(range(50), rng.randint(1, 8))
        values = [rng.random() * 3 for _ in slots]
        label = rng.randint(0, 1)
        w = [weight(i) for i in slots]
        p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, values, strict=True))))
        for i, wi, x in zip(slots, w, values, strict=True):
            g, before = (p - label) * x, n.get(i, 0.0)
            z[i] = z.get(i, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / alpha * wi
            n[i] = before + g * g
        model.update(np.array(slots), np.array(values), label)
    got = model.weights()
    assert all(math.isclose(got[i], weight(i), rel_tol=1e-9, abs_tol=1e-12) for i in range(50))
    assert not got[50:].any()


def test_scores_are_dot_products_of_shares(spark):
    rng = np.random.default_rng(5)
    weights = rng.normal(size=SLOTS + 1)
    texts = _texts()
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in quality_model.score(frame, weights).collect()}
    w = weights.astype(np.float32).astype(float)
    for i, text in enumerate(texts):
        slots = [s for b in blocks(pa.array([text], pa.string())) for s in quality_model.features(b)[1].tolist()]
        dot = w[SLOTS] + quality_model.SCALE * sum(w[s] for s in slots) / max(1, len(slots))
        want = 1 / (1 + math.exp(-dot))
        assert math.isclose(got[i].score, want, rel_tol=1e-4) and got[i].predicted == (got[i].score >= 0.5)
