"""Native expressions and aggregates vs plain-Python versions of the original
row-at-a-time semantics, on generated inputs (hypothesis)."""

import datetime as dt
import math
import statistics
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakemart.functions import columns as X
from lakemart.operators.aggregates import distinct_median, grouped_measures

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def py_signed(c):
    if c is None or c == "":
        return None
    num, quad = c[:-1], c[-1].upper()
    try:
        v = float(num)
    except ValueError:
        return None
    if quad in ("S", "W"):
        return v * -1
    if quad in ("N", "E"):
        return v
    return None


def py_round2(x):
    return None if x is None else float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


coord_text = st.one_of(
    st.none(),
    st.builds(lambda v, q: f"{v}{q}",
              st.floats(min_value=-180, max_value=180, allow_nan=False).map(lambda v: round(v, 2)),
              st.sampled_from(["N", "S", "E", "W", "n", "s", "e", "w", "X", ""])),
    st.sampled_from(["", "N", "abcN", "12..5S"]),
)


@SETTINGS
@given(st.lists(coord_text, min_size=1, max_size=30))
def test_signed_coordinate(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    got = [r.v for r in df.select(X.signed_coordinate("c").alias("v")).collect()]
    assert got == [py_signed(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(min_value=-20000, max_value=40000)), min_size=1, max_size=30))
def test_sas_to_date(spark, days):
    df = spark.createDataFrame([(None if d is None else float(d),) for d in days], "d double")
    got = [r.v for r in df.select(X.sas_to_date("d").alias("v")).collect()]
    epoch = dt.date(1960, 1, 1)
    assert got == [None if d is None else epoch + dt.timedelta(days=d) for d in days]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(min_value=-600, max_value=600).map(lambda v: v / 10)),
                min_size=1, max_size=30))
def test_fahrenheit_rounded(spark, temps):
    df = spark.createDataFrame([(t,) for t in temps], "c double")
    got = [r.v for r in df.select(X.round_half_up(X.celsius_to_fahrenheit("c"), 2).alias("v")).collect()]
    assert got == [None if t is None else py_round2(t * (9 / 5) + 32) for t in temps]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab,- ", max_size=8)), min_size=1, max_size=20),
       st.integers(min_value=0, max_value=3))
def test_split_get(spark, texts, idx):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.v for r in df.select(X.split_get("t", ",", idx).alias("v")).collect()]
    exp = []
    for t in texts:
        parts = None if t is None else t.split(",")
        exp.append(None if parts is None or idx >= len(parts) else parts[idx])
    assert got == exp


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(min_value=0, max_value=5)), min_size=1, max_size=30))
def test_trip_purpose(spark, codes):
    df = spark.createDataFrame([(c,) for c in codes], "c int")
    got = [r.v for r in df.select(X.trip_purpose("c").alias("v")).collect()]
    names = {1: "Business", 2: "Pleasure", 3: "Student"}
    assert got == [names.get(c) for c in codes]


rows_strategy = st.lists(
    st.tuples(st.sampled_from(["A", "B", "HOT"]),
              st.one_of(st.none(), st.sampled_from(["M", "F", "X"])),
              st.one_of(st.none(), st.integers(min_value=0, max_value=9)),
              st.one_of(st.none(), st.integers(min_value=-3, max_value=40))),
    min_size=1, max_size=60)


@SETTINGS
@given(rows_strategy)
def test_grouped_measures_vs_python(spark, rows):
    df = spark.createDataFrame(rows, "k string, g string, c int, v int")
    out = grouped_measures(df, ["k"], count_maps={"g": ("g", "string"), "c": ("c", "int")},
                           means={"mean_v": "v"}, medians={"med_v": "v"}, row_count_col="n")
    got = {r.k: r for r in out.collect()}
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    assert set(got) == set(groups)
    for k, rs in groups.items():
        g = got[k]
        assert g.n == len(rs)
        assert g.g == dict(Counter(r[1] for r in rs if r[1] is not None))
        assert g.c == dict(Counter(r[2] for r in rs if r[2] is not None))
        vs = [r[3] for r in rs if r[3] is not None]
        assert g.mean_v == (py_round2(sum(vs) / len(vs)) if vs else None)
        if vs:
            assert g.med_v == float(statistics.median(vs))
        else:
            assert math.isnan(g.med_v)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]),
                          st.one_of(st.none(), st.integers(min_value=-50, max_value=50).map(lambda v: v / 4))),
                min_size=1, max_size=40))
def test_distinct_median_vs_python(spark, rows):
    df = spark.createDataFrame(rows, "k string, t double")
    got = {r.k: r.m for r in df.groupBy("k").agg(distinct_median("t").alias("m")).collect()}
    for k in {r[0] for r in rows}:
        vals = sorted({r[1] for r in rows if r[0] == k and r[1] is not None})
        if vals:
            assert got[k] == float(statistics.median(vals))
        else:
            assert math.isnan(got[k])


def py_to_int(t):
    # text -> double -> int, truncating toward zero; bad text or out of range -> None
    if t is None:
        return None
    try:
        v = float(t.strip())
    except ValueError:
        return None
    if v != v or v in (float("inf"), float("-inf")) or not -2**31 <= int(v) < 2**31:
        return None
    return int(v)


@SETTINGS
@given(st.lists(st.one_of(
    st.none(),
    st.integers(min_value=-10**6, max_value=10**6).map(str),
    st.floats(min_value=-1e6, max_value=1e6, allow_nan=False).map(lambda v: f"{v:.3f}"),
    st.sampled_from(["4.0", " 12 ", "abc", "", "1e3", "-7.9", "3000000000"])), min_size=1, max_size=30))
def test_to_int_text(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.v for r in df.select(X.to_int("t").alias("v")).collect()]
    assert got == [py_to_int(t) for t in texts]


def test_count_map_single_column_and_explode(spark):
    from lakemart.operators.aggregates import count_map, explode_map

    df = spark.createDataFrame([("A", "x"), ("A", "x"), ("A", None), ("B", None)], "k string, v string")
    maps = {r.k: r.v for r in count_map(df, ["k"], "v").collect()}
    assert maps == {"A": {"x": 2}, "B": {}}
    long = sorted(tuple(r) for r in explode_map(count_map(df, ["k"], "v"), ["k"], "v").collect())
    assert long == [("A", "x", 2)]


def test_pivot_agg_dict_and_column_specs(spark):
    from pyspark.sql import functions as F

    from lakemart.operators.aggregates import pivot_agg, pivot_sum

    df = spark.createDataFrame([("c", "r1", "1.5"), ("c", "r1", "2"), ("c", "r2", "x"), ("d", "r3", "4")],
                               "k string, p string, n string")
    by_dict = {r.k: (r.one, r.two) for r in pivot_sum(df, ["k"], "p", ["r1", "r2"], "n",
                                                       {"r1": "one", "r2": "two"}).collect()}
    assert by_dict == {"c": (3.5, None), "d": (None, None)}
    by_col = {r.k: (r.r1, r.r2) for r in pivot_agg(df, ["k"], "p", ["r1", "r2"], F.count("n"), fill=0).collect()}
    assert by_col == {"c": (2, 1), "d": (0, 0)}
