
import pytest
from pyspark.sql import functions as F

from lakemart.operators import quality as Q
from lakemart.operators.aggregates import grouped_measures, lower_median
from lakemart.operators.joins import join_measures, unique_by
from lakemart.plans import builders as B
from lakemart.plans import contract as C


def test_map_values_sum_to_non_null_inputs(spark, sf001):
    trips = C.trips(spark, sf001)
    fact = B.build_immigration(trips, with_visits=True)
    sums = fact.select(
        *B.FACT_KEYS,
        F.aggregate(F.map_values("gender"), F.lit(0), lambda a, x: a + x).alias("g"),
        F.aggregate(F.map_values("countries"), F.lit(0), lambda a, x: a + x).alias("c"),
    )
    direct = trips.groupBy(*B.FACT_KEYS).agg(F.count("gender").alias("g2"), F.count("country_id").alias("c2"))
    bad = sums.join(direct, B.FACT_KEYS).filter((F.col("g") != F.col("g2")) | (F.col("c") != F.col("c2")))
    assert bad.count() == 0


def test_fact_keys_and_ids_unique(spark, sf001):
    fact = B.build_immigration(C.trips(spark, sf001))
    assert Q.duplicate_keys(fact, B.FACT_KEYS).first().duplicate_keys == 0
    n = fact.count()
    assert fact.select("immigration_id").distinct().count() == n


def test_lower_median_is_exact_in_large_groups(spark):
    n = 60_000  # more values in a group than the former sketch kept apart (10,000)
    big = spark.range(n).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % n * (F.col("id") * 7919 % n)).alias("v"))
    small = spark.createDataFrame([("even", 4), ("even", 1), ("even", 2), ("even", 2), ("odd", 3), ("odd", None), ("none", None), (None, 2**62 + 1)], "k string, v long")
    got = lower_median(big.unionAll(small), ["k"], "v", "med")
    assert got.schema["med"].dataType.typeName() == "long"
    want = sorted((i * 7919 % n) ** 2 for i in range(n))[(n - 1) // 2]
    assert {r.k: r.med for r in got.collect()} == {"hot": want, "even": 2, "odd": 3, "none": None, None: 2**62 + 1}
    approx = big.agg(F.percentile_approx("v", 0.5, 10000)).first()[0]
    assert approx != want


def test_stable_ids(spark, sf001):
    fact = B.build_immigration(C.trips(spark, sf001), stable_id=True)
    a = {(r.month, r.airport_cd): r.immigration_id for r in fact.collect()}
    b = {(r.month, r.airport_cd): r.immigration_id for r in fact.repartition(3).collect()}
    assert a == b


def test_invariant_under_repartition(spark, sf001):
    raw = C.raw_arrivals(spark, sf001)
    f1 = B.build_immigration(B.clean_arrivals(raw), empty_median="null").drop("immigration_id")
    f2 = B.build_immigration(B.clean_arrivals(raw.repartition(7, "i94cit")), empty_median="null").drop("immigration_id")
    cols = ["month", "airport_cd", "avg_stay", "median_age"]
    assert sorted(f1.select(*cols).collect()) == sorted(f2.select(*cols).collect())
    exploded = lambda f: sorted(f.select(*B.FACT_KEYS, F.explode("countries")).collect())
    assert exploded(f1) == exploded(f2)


def test_null_month_keeps_measures(spark):
    df = spark.createDataFrame(
        [(None, "ATL", 30, 5, "M"), (None, "ATL", 40, 7, "F"), (4, "ATL", 50, 1, None)],
        "month int, airport_cd string, age int, stay int, gender string")
    out = grouped_measures(df, ["month", "airport_cd"], count_maps={"gender": ("gender", "string")},
                           means={"avg_stay": "stay"}, medians={"median_age": "age"}, row_count_col="n")
    got = {r.month: r for r in out.collect()}
    assert got[None].n == 2 and got[None].avg_stay == 6.0 and got[None].median_age == 35.0
    assert got[None].gender == {"F": 1, "M": 1}
    assert got[4].gender == {}


def test_hot_group_spread(spark):
    # one key with most rows: the first-level count stays per (key, value), and the
    # result equals plain aggregates
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 10 < 8, F.lit("HOT")).otherwise((F.col("id") % 97).cast("string")).alias("k"),
        (F.col("id") % 83).cast("int").alias("v"))
    out = grouped_measures(df, ["k"], means={"m": "v"}, medians={"med": "v"}, row_count_col="n",
                           empty_median="null")
    ref = df.groupBy("k").agg(F.round(F.avg("v"), 2).alias("m"), F.median("v").alias("med"),
                              F.count(F.lit(1)).alias("n"))
    assert sorted(out.select("k", "m", "med", "n").collect()) == sorted(ref.select("k", "m", "med", "n").collect())


def test_join_measures_null_safe(spark):
    base = spark.createDataFrame([(None, "A", 1), (1, "A", 2)], "m int, a string, x int")
    other = spark.createDataFrame([(None, "A", 10), (1, "A", 20)], "m int, a string, y int")
    got = sorted((r.x, r.y) for r in join_measures(base, [other], ["m", "a"]).collect())
    assert got == [(1, 10), (2, 20)]
    plain = sorted((r.x, r.y) for r in join_measures(base, [other], ["m", "a"], null_safe=False).collect())
    assert plain == [(1, None), (2, 20)]


def test_unique_by(spark):
    df = spark.createDataFrame([("A", "z", 1), ("A", "b", 2), ("B", "c", 3)], "k string, name string, x int")
    got = sorted(unique_by(df, ["k"]).collect())
    assert [tuple(r) for r in got] == [("A", "b", 2), ("B", "c", 3)]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (2, "b"), (None, "b")], "k int, s string")
    nulls = {r.column_name: r.null_count for r in Q.null_counts(df).collect()}
    assert nulls == {"k": 1, "s": 1}
    wide = Q.null_counts(df, long=False).first()
    assert (wide.k, wide.s) == (1, 1)
    assert Q.duplicate_keys(df, ["k"]).first().duplicate_keys == 1
    dc = Q.distinct_count(df, ["k"], expected=3).first()
    assert dc.distinct_count == 3 and dc.as_expected
    prof = {r.column_name: (r.data_type, r.non_null) for r in Q.profile(df).collect()}
    assert prof == {"k": ("int", 3), "s": ("string", 3)}
    assert Q.has_type(df, "s", __import__("pyspark.sql.types", fromlist=["StringType"]).StringType())
    assert Q.max_value(df, "k").first()[0] == 2
    assert sorted(r.s for r in Q.categories(df, "s").collect() if r.s) == ["a", "b"]
    assert Q.preview(df, 2).count() == 2
    dim = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert Q.join_coverage(df, dim, "k", ["k", "s"]).first().matched == 2


def test_union_all_modes(spark):
    from lakemart.operators.setops import union_all

    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, k int")
    by_name = sorted(tuple(r) for r in union_all([a, b]).collect())
    assert by_name == [(1, "x"), (2, "y")]
    c = spark.createDataFrame([(3,)], "k int")
    assert union_all([a, c], allow_missing_columns=True).filter("s IS NULL").count() == 1
    same = spark.createDataFrame([(4, "z")], "k int, s string")
    assert union_all([a, same], by_name=False).count() == 2


def test_read_csv_with_schema_checks_header(spark, tmp_path):
    import pytest
    from pyspark.sql import types as T

    from lakemart.sources.readers import read_csv

    p = tmp_path / "t.csv"
    p.write_text("a;b\n1;x\n")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    assert read_csv(spark, str(p), sep=";", schema=schema).collect()[0].b == "x"
    wrong = T.StructType([T.StructField("a", T.StringType()), T.StructField("c", T.StringType())])
    with pytest.raises(Exception):
        read_csv(spark, str(p), sep=";", schema=wrong).collect()


def test_sink_writers_spread_folders(spark):
    from lakemart.session import scratch_dir
    from lakemart.sources.schemas import TEMPERATURE_OUT_SCHEMA
    from lakemart.sources.sinks import read_back, write_table

    df = spark.range(0, 40).selectExpr(
        "cast(id % 12 + 1 as int) as month", "concat('c', id) as city",
        "1.0d as latitude", "2.0d as longitude", "cast(id as double) as median_avg_temp")
    path = scratch_dir(spark, "writers")
    write_table(df, path, ["month", "city"], writers=4)
    back = read_back(spark, path, TEMPERATURE_OUT_SCHEMA, ["month", "city"])
    assert sorted(back.collect()) == sorted(df.collect())
    assert back.filter("month = 3").count() == df.filter("month = 3").count()


def test_join_on_keys_null_safe_outer(spark):
    from lakemart.operators.joins import join_on_keys

    left = spark.createDataFrame([(None, 1), (1, 2), (2, 3)], "k int, x int")
    right = spark.createDataFrame([(None, 10), (1, 20), (3, 30)], "k int, y int")
    full = sorted((r.k if r.k is not None else -1, r.x, r.y)
                  for r in join_on_keys(left, right, ["k"], how="full", null_safe=True).collect())
    assert full == sorted([(-1, 1, 10), (1, 2, 20), (2, 3, None), (3, None, 30)], key=lambda t: (t[0], t[1] or 0))
    semi = sorted(r.x for r in join_on_keys(left, right, ["k"], how="left_semi", null_safe=True).collect())
    assert semi == [1, 2]
    assert join_on_keys(left, right, ["k"], how="full", null_safe=True).columns == ["k", "x", "y"]


def test_fact_measures_subset_equals_full(spark, sf001):
    clean = C.trips(spark, sf001)
    full = B.build_immigration(clean, empty_median="null", stable_id=True)
    for some in ([], ["avg_stay"], ["airlines", "median_age"]):
        part = B.build_immigration(clean, empty_median="null", stable_id=True, measures=some)
        maps = [c for c in part.columns if c in B.MAP_MEASURES]
        as_rows = lambda df: sorted((repr(r) for r in df.select(
            *[F.array_sort(F.map_entries(c)).alias(c) if c in maps else c for c in part.columns]).collect()))
        assert as_rows(part) == as_rows(full)
    with pytest.raises(ValueError):
        B.build_immigration(clean, measures=["nothing"])


def test_csv_of_another_layout_raises_or_is_read_by_name(spark):
    from lakemart.session import scratch_dir
    from lakemart.sources.readers import read_csv, read_csv_by_name

    base = scratch_dir(spark, "unequal")
    spark.createDataFrame([("1", "a")], "x string, y string").coalesce(1).write.csv(f"{base}/in/a", header=True)
    spark.createDataFrame([("b", "2")], "y string, x string").coalesce(1).write.csv(f"{base}/in/b", header=True)
    with pytest.raises(Exception, match="header"):
        read_csv(spark, f"{base}/in", recursive=True).collect()
    got = read_csv_by_name(spark, [f"{base}/in/a", f"{base}/in/b"], ["x", "y"]).collect()
    assert sorted(tuple(r) for r in got) == [("1", "a"), ("2", "b")]
