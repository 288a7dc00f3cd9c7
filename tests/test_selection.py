"""Medians by selection, nearest locations and increasing ids against plain Python."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from lakemart.operators.ids import dense_ids, stable_ids, with_ids
from lakemart.operators.nearest import nearest_locations
from lakemart.operators.selection import select_ranks, selected_median
from lakemart.session import scratch_dir


def _values(seed):
    rng = random.Random(seed)
    rows = [("hot", rng.gauss(0, 1) * 10 ** rng.randint(-12, 12)) for _ in range(5001)]
    rows += [("even", float(i * 7 % 4000)) for i in range(4000)] + [("same", 3.5)] * 3000 + [("two", 1.0)] * 1500 + [("two", 2.0)] * 1500
    rows += [("ties", float(rng.choice([1, 1, 1, 2, 3, 900]))) for _ in range(2500)] + [(None, rng.random()) for _ in range(2001)]
    rows += [("small", float(i)) for i in range(10)] + [("hot", None)] * 50 + [("none", None)] * 3 + [("one", 4.0)]
    rows += [("skewed", 1e300), ("skewed", -1e300)] + [("skewed", rng.random()) for _ in range(2999)]
    rng.shuffle(rows)
    return rows


def test_selected_median_matches_python(spark):
    rows = _values(1)
    df = spark.createDataFrame([(k, v, 1) for k, v in rows], "k string, v double, n int").repartition(6)
    want = {}
    for k, v in rows:
        want.setdefault(k, []).extend([] if v is None else [v])
    want = {k: statistics.median(v) if v else None for k, v in want.items()}
    for hot, ranges in ((100, 4), (500, 64), (1 << 18, 64)):
        got = {r.k: r.med for r in selected_median(df, ["k"], "v", "med", "null", hot, ranges).collect()}
        assert got.keys() == want.keys()
        for k, m in want.items():
            assert got[k] == m if m is None else got[k] == pytest.approx(m, rel=1e-15), k


def test_selected_median_of_nothing(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert selected_median(df, ["k"], "v").collect() == []
    nan = selected_median(spark.createDataFrame([("a", None)], "k string, v double"), ["k"], "v").collect()
    assert math.isnan(nan[0].v)


def test_any_ranks(spark):
    rng = random.Random(2)
    values = [rng.choice([rng.random(), 5.0, float("inf"), -0.5]) for _ in range(3000)]
    df = spark.createDataFrame([(1, v) for v in values], "k int, v double").repartition(5)
    ranks = [0, 1, 1499, 1500, 2998, 2999, 700]
    targets = spark.createDataFrame([(1, w, k) for w, k in enumerate(ranks)], "k int, w int, r long").withColumnsRenamed({"k": "g", "r": "k"})
    got = select_ranks(df.withColumnRenamed("k", "g"), targets, ["g"], hot_rows=50, ranges=8).collect()
    assert {r.w: r.value for r in got} == {w: sorted(values)[k] for w, k in enumerate(ranks)}


def test_hot_group_is_not_held_by_one_task(spark):
    """The rounds' stored rows shrink; no aggregate above hot_rows values is made."""
    df = spark.range(0, 40_000, 1, 8).select(F.lit(1).alias("k"), (F.col("id") * 1.5).alias("v"))
    assert selected_median(df, ["k"], "v", hot_rows=1000).first().v == 39_999 * 1.5 / 2


def test_temperature_of_any_precision(spark, sf001):
    from lakemart.plans import builders as B
    from lakemart.plans import contract as C

    raw = C.raw_temperature(spark, sf001)
    one = sorted(map(tuple, B.build_temperature(raw, empty_median="null").collect()))
    assert sorted(map(tuple, B.build_temperature(raw, empty_median="null", hot_rows=5).collect())) == one


def _distance(a, b):
    east = abs(a[1] - b[1]) % 360
    east = min(east, 360 - east)
    return (a[0] - b[0]) ** 2 + east ** 2


def test_nearest_location_matches_all_pairs(spark):
    rng = random.Random(3)
    place = lambda: (round(rng.uniform(-90, 90), rng.choice([0, 2])), round(rng.uniform(-180, 180), rng.choice([0, 2])))
    left = [(rng.choice("abcd"), *place()) for _ in range(150)] + [("a", 0.0, 179.9), ("a", 0.0, -180.0), ("a", 90.0, 0.0), ("e", 1.0, 1.0), (None, 1.0, 1.0)]
    right = [(k, *place()) for k in "abc" for _ in range({"a": 60, "b": 3, "c": 1}[k])] + [("a", 0.0, -179.9), ("f", 0.0, 0.0), (None, 1.0, 1.0)]
    right += [("d", 10.0, 10.0), ("d", 10.0, 10.1), ("d", 10.02, 10.0), ("d", None, 3.0)]
    left += left[:40] + [("c", None, 1.0), ("b", None, None), ("d", 10.0, 10.05)]
    schema = "city string, latitude double, longitude double"
    got = nearest_locations(spark.createDataFrame(left, schema).repartition(4), spark.createDataFrame(right, schema), ["city"]).collect()
    want = set()
    for k, *at in left:
        own = [tuple(p) for c, *p in right if c == k and None not in p]
        if k is None or not own:
            continue
        if None in at:
            if len(set(own)) == 1:
                want.add((k, *at, *own[0]))
        else:
            want.add((k, *at, *min(own, key=lambda p: (_distance(at, p), p))))
    assert len(got) == len(want) and set(map(tuple, got)) == want


def test_nearest_location_of_empty_tables(spark):
    schema = "city string, latitude double, longitude double"
    none, one = spark.createDataFrame([], schema), spark.createDataFrame([("a", 1.0, 2.0)], schema)
    for a, b in ((none, one), (one, none), (none, none)):
        assert nearest_locations(a, b, ["city"]).collect() == []


def test_snowflake_by_place_keeps_the_fact_rows(spark, sf001):
    from __spark_entry__ import queries

    rows = queries()["snowflake_by_place"](spark, sf001).collect()
    assert len(rows) == len({(r.month, r.airport_cd) for r in rows}) and any(r.median_avg_temp for r in rows)


def test_dense_ids_follow_the_keys(spark):
    rows = [(m, a) for m in (None, 3, 1, 2) for a in ("x", "é", None, "a", "Z")]
    df = spark.createDataFrame(rows * 3, "m int, a string").repartition(7)
    got = dense_ids(df, ["m", "a"], start=5).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    assert {(r.m, r.a): r.id for r in got} == {k: i + 5 for i, k in enumerate(order)}
    assert dense_ids(df.where("false"), ["m", "a"]).collect() == []


def test_stable_ids_go_on(spark):
    path = scratch_dir(spark, "ids")
    frame = lambda ks: spark.createDataFrame([(k,) for k in ks], "k string")
    one = {r.k: r.id for r in stable_ids(frame(["b", "d", "b"]), ["k"], path).collect()}
    assert one == {"b": 0, "d": 1}
    two = {r.k: r.id for r in stable_ids(frame(["a", "c", "d", None]), ["k"], path).collect()}
    assert two == {"b": 0, "d": 1, None: 2, "a": 3, "c": 4}
    assert {r.k: r.id for r in stable_ids(frame(["a", None]), ["k"], path).collect()} == two
    rows = with_ids(frame(["c", None, "c"]).withColumn("id", F.lit("old")), stable_ids(frame([]), ["k"], path), ["k"], "id")
    assert sorted(r.id for r in rows.collect()) == [2, 4, 4] and rows.columns == ["k", "id"]
