"""Contract queries: every operator run on the driver's tables.

The original raw files are not available, so each builder is fed an
*analogue* raw frame derived from the TPC-H-like tables (arrivals from
lineitem x orders x customer x part, airports from supplier x nation, city
demographics from customer x nation, temperatures from lineitem x supplier x
nation).  The analogue frames only rename and re-encode columns; the library
builders then run unchanged, over the whole tables.  The matching DuckDB SQL
lives in :mod:`lakemart.plans.oracle`.

Compared outputs hold no map/array columns (maps are checked in long form)
and use ``empty_median='null'`` so that an empty group is NULL on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions import columns as X
from lakemart.operators import quality as Q
from lakemart.operators.aggregates import (count_map, explode_map, exact_median, lower_median, pivot_agg,
                                           pivot_sum, rounded_mean, row_count)
from lakemart.operators.joins import join_measures, snowflake, unique_by
from lakemart.operators.selection import selected_median
from lakemart.operators.setops import union_all
from lakemart.plans import builders as B
from lakemart.plans import pipeline as P
from lakemart.session import scratch_dir, stored
from lakemart.sources.readers import read_csv, read_csv_by_name
from lakemart.sources.schemas import (AIRPORT_SCHEMA, DEMOGRAPHICS_OUT_SCHEMA, DEMOGRAPHICS_PARTITIONS, IMMIGRATION_SCHEMA,
                                      TEMPERATURE_OUT_SCHEMA)
from lakemart.sources.sinks import default_writers, read_back, read_output, write_bucketed, write_table

KEYS = B.FACT_KEYS
# analogue encodings (fixed for the contract; the oracle SQL repeats them)
SEGMENT_RACE = {
    "AUTOMOBILE": "American Indian and Alaska Native",
    "BUILDING": "Asian",
    "FURNITURE": "Black or African-American",
    "HOUSEHOLD": "Hispanic or Latino",
    "MACHINERY": "White",
}
TEMPERATURE_YEAR_SHIFT = 47
#: Buckets of the bucketed trips, at a size of some GB; a bucket is one task of the joins above it.
BUCKETS = 32


# Schemas of the driver's tables.  Reading with an explicit schema skips the
# footer-reading job of schema inference (one per read; at scale one pass
# over thousands of footers).
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = DRIVER_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


# --- analogue raw inputs ---------------------------------------------------------------

def raw_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival-shaped rows: one per line item (numbers as doubles, like binary files)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount",
        "l_returnflag", "l_linestatus", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    j = (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(cust, F.col("o_custkey") == F.col("c_custkey"))
         .join(part, F.col("l_partkey") == F.col("p_partkey")))
    epoch = F.lit(X.SAS_EPOCH).cast("date")
    return j.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("cicid"),
        F.month("l_shipdate").cast("double").alias("i94mon"),
        F.col("c_nationkey").cast("double").alias("i94cit"),
        F.when(F.col("p_type") == "ECONOMY", F.lit("XXX"))
         .otherwise(F.col("l_suppkey").cast("string")).alias("i94port"),
        F.datediff(F.col("o_orderdate").cast("date"), epoch).cast("double").alias("arrdate"),
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("double"))
         .otherwise(F.datediff(F.col("l_shipdate").cast("date"), epoch).cast("double")).alias("depdate"),
        F.when(F.col("l_linestatus") == "O", F.lit(1.0)).otherwise(F.lit(2.0)).alias("i94mode"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("double"))
         .otherwise(F.col("l_quantity")).alias("i94bir"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("i94visa"),
        # some (month, port) groups have no gender at all
        F.when((F.col("l_suppkey") + F.month("l_shipdate")) % 7 == 0, F.lit(None).cast("string"))
         .when(F.col("l_returnflag") == "N", F.lit("X")).otherwise(F.col("l_returnflag")).alias("gender"),
        F.col("p_brand").alias("airline"),
        F.col("c_mktsegment").alias("visatype"),
    )


def raw_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport-code rows from supplier x nation, every row present twice."""
    sup = table(spark, sf_dir, "supplier")
    nat = table(spark, sf_dir, "nation")
    rows = sup.join(nat, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.when(F.col("s_acctbal") < 0, F.lit(None).cast("string"))
         .otherwise(F.col("s_suppkey").cast("string")).alias("iata_code"),
        F.when(F.col("s_acctbal").between(0, 999.99), F.lit("heliport"))
         .when(F.col("s_acctbal") < 5000, F.lit("small_airport"))
         .otherwise(F.lit("large_airport")).alias("type"),
        F.col("s_name").alias("name"),
        F.when(F.col("n_regionkey") == 3, F.lit("GB")).otherwise(F.lit("US")).alias("iso_country"),
        F.when(F.col("n_regionkey") == 4, F.lit("US"))
         .otherwise(F.concat(F.lit("US-R"), F.col("n_regionkey").cast("string"))).alias("iso_region"),
        F.col("n_name").alias("municipality"),
        F.concat((F.col("s_acctbal") / 100).cast("string"), F.lit(", "),
                 (F.col("n_nationkey") + 0.5).cast("string")).alias("coordinates"),
    )
    return union_all([rows, rows])


def raw_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City-file rows (all text): one per customer, city = nation, race = segment."""
    cust = table(spark, sf_dir, "customer")
    nat = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    txt = lambda c: c.cast("string")
    return cust.join(nat, F.col("c_nationkey") == k).select(
        F.col("n_name").alias("City"),
        F.when(F.col("n_regionkey") == 4, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("R"), F.col("n_regionkey").cast("string"))).alias("State Code"),
        txt(k + 20.5).alias("Median Age"),
        txt(k * 1000).alias("Male Population"),
        txt(k * 1100 + 7).alias("Female Population"),
        txt(k * 2100 + 7).alias("Total Population"),
        txt(k * 10).alias("Number of Veterans"),
        txt(F.col("n_regionkey").cast("double")).alias("Foreign-born"),
        txt(F.col("n_regionkey") + 1.25).alias("Average Household Size"),
        X.map_codes("c_mktsegment", SEGMENT_RACE).alias("Race"),
        txt(F.col("c_acctbal").cast("bigint")).alias("Count"),
    )


def raw_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperature-file rows (all text) from lineitem x supplier x nation."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_quantity", "l_discount", "l_returnflag", "l_shipdate")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = table(spark, sf_dir, "nation")
    j = (li.join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(nat, F.col("s_nationkey") == F.col("n_nationkey")))
    celsius = F.col("l_quantity") - 20 + F.col("l_discount") * 10
    return j.select(
        F.make_date(F.year("l_shipdate") - TEMPERATURE_YEAR_SHIFT, F.month("l_shipdate"),
                    F.least(F.dayofmonth("l_shipdate"), F.lit(28))).cast("string").alias("dt"),
        F.when(F.col("l_returnflag") == "N", F.lit(None).cast("string"))
         .otherwise(celsius.cast("string")).alias("AverageTemperature"),
        F.col("n_name").alias("City"),
        F.when(F.col("n_regionkey") == 2, F.lit("France")).otherwise(F.lit(B.US_COUNTRY)).alias("Country"),
        F.concat((F.col("n_nationkey") + 10.5).cast("string"),
                 F.when(F.col("n_nationkey") < 12, F.lit("N")).otherwise(F.lit("s"))).alias("Latitude"),
        F.concat((F.col("n_regionkey") * 20 + 0.25).cast("string"), F.lit("W")).alias("Longitude"),
    )


# --- builder outputs used by several queries --------------------------------------------

def trips(spark, d):
    return B.clean_arrivals(raw_arrivals(spark, d))


def fact(spark, d, with_visits=True, measures=None):
    return B.build_immigration(trips(spark, d), empty_median="null", with_visits=with_visits, measures=measures)


def airports(spark, d):
    return B.build_airports(raw_airports(spark, d))


def demographics(spark, d):
    return B.build_demographics(raw_demographics(spark, d))


def temperature(spark, d):
    return B.build_temperature(raw_temperature(spark, d), empty_median="null")


# --- queries -----------------------------------------------------------------------------

def q_clean_trips(spark, d):
    return trips(spark, d)


def q_group_count(spark, d):
    return trips(spark, d).groupBy(*KEYS).agg(row_count().alias("n"))


def q_avg_stay(spark, d):
    return trips(spark, d).groupBy(*KEYS).agg(rounded_mean("length_of_stay").alias("avg_stay"))


def q_median_age(spark, d):
    return trips(spark, d).groupBy(*KEYS).agg(exact_median("age", "null").alias("median_age"))


def q_approx_median_age(spark, d):
    return lower_median(trips(spark, d), KEYS, "age", "approx_median_age")


def _count_map_query(map_col):
    def q(spark, d):
        column, key_type = B.MAP_MEASURES[map_col]
        return explode_map(count_map(trips(spark, d), KEYS, column, key_type, map_col), KEYS, map_col, "key", "n")
    q.__name__ = f"q_count_map_{map_col}"
    return q


def q_fact_wide(spark, d):
    f = fact(spark, d)
    return f.select(
        *KEYS, "visits", "avg_stay", "median_age",
        F.size("gender").alias("n_genders"),
        F.size("trip_purpose").alias("n_trip_purposes"),
        F.size("visa_type").alias("n_visa_types"),
        F.size("countries").alias("n_countries"),
        F.size("airlines").alias("n_airlines"),
    )


def q_join_measures(spark, d):
    """J1 in its original form: per-measure aggregates left-joined onto the count table.
    The cleaned rows are written once, so the three aggregates share one dedup."""
    path = scratch_dir(spark, "trips")
    cleaned = trips(spark, d).select(*KEYS, "length_of_stay", "age")
    write_table(cleaned, path)
    t = spark.read.schema(cleaned.schema).parquet(path)
    base = t.groupBy(*KEYS).agg(row_count().alias("visits"))
    stay = t.groupBy(*KEYS).agg(rounded_mean("length_of_stay").alias("avg_stay"))
    age = t.groupBy(*KEYS).agg(exact_median("age", "null").alias("median_age"))
    return join_measures(base, [stay, age], KEYS)


def q_surrogate_id(spark, d):
    return fact(spark, d, with_visits=False, measures=()).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("immigration_id").alias("n_ids"))


def q_sas_date(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", X.sas_to_date(F.col("o_custkey").cast("double")).alias("sas_date"))


def q_map_codes(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", X.trip_purpose(X.to_int(F.substring("o_orderpriority", 1, 1))).alias("trip_purpose"))


def q_null_if(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", X.null_if("l_returnflag", "N").alias("flag"))


def q_split_get(spark, d):
    p = table(spark, d, "part")
    return p.select(
        "p_partkey",
        X.split_get("p_name", " ", 0).alias("word0"),
        X.split_get("p_name", " ", 1).alias("word1"),
        X.split_get("p_name", " ", 2).alias("word2"),
        X.split_get("p_brand", "#", 1).alias("brand_no"),
    )


def q_try_casts(spark, d):
    p = table(spark, d, "part")
    price_txt = F.col("p_retailprice").cast("string")
    return p.select(
        "p_partkey",
        X.to_int(X.split_get("p_brand", "#", 1)).alias("brand_no"),
        X.to_double(F.concat(F.lit(" "), price_txt)).alias("price"),
        X.to_int(price_txt).alias("price_int"),
        X.to_double("p_name").alias("bad_number"),
    )


def q_parse_dates(spark, d):
    o = table(spark, d, "orders")
    txt = F.date_format("o_orderdate", "yyyy-MM-dd")
    parsed = o.select("o_orderkey", X.parse_date(txt).alias("order_date"),
                      X.parse_date(F.concat(F.lit("x"), txt)).alias("bad_date"))
    return (parsed.filter(F.year("order_date") >= 1998)
            .select("o_orderkey", "order_date", "bad_date",
                    F.year("order_date").alias("yr"), F.month("order_date").alias("mon")))


def q_c_to_f(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", X.round_half_up(X.celsius_to_fahrenheit("p_size"), 2).alias("temp_f"))


def q_signed_coord(spark, d):
    s = table(spark, d, "supplier")
    k = F.col("s_nationkey")
    letter = (F.when(k < 5, "N").when(k < 10, "S").when(k < 15, "e")
              .when(k < 20, "w").otherwise("X"))
    digits = F.when(k == 0, F.lit("abc")).otherwise(F.col("s_acctbal").cast("string"))
    return s.select("s_suppkey", X.signed_coordinate(F.concat(digits, letter)).alias("coord"))


def q_like_filter(spark, d):
    p = table(spark, d, "part")
    return (p.filter(F.col("p_type").like("%M%")).filter(F.col("p_brand") == "Brand#2")
            .select("p_partkey", "p_name", "p_type", "p_brand"))


def q_null_drop(spark, d):
    li = table(spark, d, "lineitem")
    x = li.select("l_orderkey", "l_linenumber",
                  X.null_if("l_returnflag", "N").alias("flag"),
                  X.null_if("l_linestatus", "O").alias("status"))
    return x.na.drop(subset=["flag"]).filter(F.col("status").isNull())


def q_pivot_sum(spark, d):
    c = table(spark, d, "customer").select(
        "c_nationkey", "c_mktsegment", F.col("c_acctbal").cast("bigint").cast("string").alias("bal"))
    renames = {s: s.lower() for s in SEGMENT_RACE}
    out = pivot_sum(c, ["c_nationkey"], "c_mktsegment", list(SEGMENT_RACE), "bal", renames)
    return out.select("c_nationkey", *[X.to_long(v).alias(v) for v in renames.values()])


def q_pivot_join(spark, d):
    return demographics(spark, d)


def q_distinct_median(spark, d):
    return temperature(spark, d)


def q_airport_dim(spark, d):
    return airports(spark, d)


def q_union_files(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    ln = F.col("l_linenumber")
    parts = [li.filter(ln <= 2), li.filter((ln > 2) & (ln <= 4)), li.filter((ln > 4) | ln.isNull())]
    return union_all(parts)


def q_null_counts(spark, d):
    return Q.null_counts(trips(spark, d))


def q_dup_keys(spark, d):
    return Q.duplicate_keys(fact(spark, d, with_visits=False, measures=()), ["airport_cd"])


def q_dup_fact_keys(spark, d):
    return Q.duplicate_keys(fact(spark, d, with_visits=False, measures=()), KEYS)


def q_distinct_count(spark, d):
    return Q.distinct_count(fact(spark, d, with_visits=False, measures=()), ["month"], expected=12)


def q_join_coverage(spark, d):
    return Q.join_coverage(fact(spark, d, with_visits=False, measures=()), airports(spark, d), "airport_cd", KEYS)


def q_profile(spark, d):
    return Q.profile(trips(spark, d))


def q_max_year(spark, d):
    raw = raw_temperature(spark, d).filter(F.col("Country") == B.US_COUNTRY)
    return Q.max_value(raw.select(F.year(X.parse_date("dt")).alias("year")), "year", "max_year")


def q_categories(spark, d):
    return Q.categories(raw_airports(spark, d), "type")


def q_snowflake_join(spark, d):
    f = fact(spark, d, with_visits=False, measures=["avg_stay", "median_age"])
    return snowflake(f, airports(spark, d), demographics(spark, d), temperature(spark, d),
                     fact_cols=["month", "airport_cd", "avg_stay", "median_age"])


def _filtered_raw(spark, d):
    raw = raw_arrivals(spark, d)
    return (raw.filter(X.to_double("i94mode") == 1.0).filter(~F.col("i94port").isin(*X.INVALID_PORTS))
            .select(X.to_int("i94mon").alias("month"), F.col("i94port").alias("airport_cd"), "cicid", "gender"))


def q_pivot_gender(spark, d):
    return pivot_agg(_filtered_raw(spark, d).where("gender IS NOT NULL"), KEYS, "gender", ["A", "R"],
                     F.count_distinct("cicid"), renames={"A": "n_a", "R": "n_r"}, fill=0)


def q_pivot_trip(spark, d):
    return pivot_agg(trips(spark, d), KEYS, "trip_purpose", ["Business", "Pleasure", "Student"],
                     F.count("trip_purpose"),
                     renames={"Business": "business", "Pleasure": "pleasure", "Student": "student"}, fill=0)


def q_avg_age(spark, d):
    return trips(spark, d).groupBy(*KEYS).agg(rounded_mean("age").alias("avg_age"))


def q_snowflake_by_place(spark, d):
    """J4 where city names repeat (first letters): each fact row gets the temperature of the nearest city of its name."""
    first = lambda df: df.withColumn("city", F.substring("city", 1, 1))
    f = fact(spark, d, with_visits=False, measures=["avg_stay"])
    return snowflake(f, first(airports(spark, d)), first(demographics(spark, d)).where("false"), first(temperature(spark, d)),
                     fact_cols=["month", "airport_cd", "avg_stay"], by_place=True).select(
        "month", "airport_cd", "city", "avg_stay", "median_avg_temp")


def _hot_values(spark, d):
    """Line items in unequal groups of values that all differ; the first has a good part of all rows."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    n = F.col("l_linenumber")
    return li.select(F.when(n <= 2, F.lit(0)).when(n == 7, F.lit(None).cast("int")).otherwise(n).alias("grp"),
                     (F.col("l_extendedprice") * 1000003.0 + (F.col("l_orderkey") * 8 + n)).alias("v"))


def q_hot_median(spark, d):
    """A3 where a group's values are too many for one buffer: ranks selected over several rounds."""
    return selected_median(_hot_values(spark, d), ["grp"], "v", "median_v", empty="null", hot_rows=1000)


def q_join_measures_bucketed(spark, d):
    """J1 over a table bucketed by the keys: three aggregates and two joins without a shuffle."""
    cleaned = trips(spark, d).select(F.coalesce("month", F.lit(0)).alias("month"), "airport_cd", "length_of_stay", "age")
    t = write_bucketed(cleaned, scratch_dir(spark, "bucketed"), KEYS, BUCKETS)
    base = t.groupBy(*KEYS).agg(row_count().alias("visits"))
    stay = t.groupBy(*KEYS).agg(rounded_mean("length_of_stay").alias("avg_stay"))
    age = t.groupBy(*KEYS).agg(exact_median("age", "null").alias("median_age"))
    return join_measures(base, [stay, age], KEYS, null_safe=False).withColumn("month", X.null_if("month", 0))


def q_pruned_join(spark, d):
    """K1 + J4 over stored tables: the airports of one state prune the fact's folders at run time."""
    stored_fact = _stored_fact(spark, d)
    path = scratch_dir(spark, "airports")
    write_table(airports(spark, d), path)
    dim = unique_by(read_back(spark, path, AIRPORT_SCHEMA).where("airport_cd IS NOT NULL AND state = 'R1'"), ["airport_cd"])
    return stored_fact.join(dim.select("airport_cd", "city"), "airport_cd").select("month", "airport_cd", "city", "avg_stay")


def q_dup_refresh_keys(spark, d):
    """Q2 where keys do repeat: the facts of two refreshes, the second of which covers the first."""
    t = trips(spark, d).select(*KEYS)
    first = B.build_immigration(t.where("month <= 6"), measures=())
    return Q.duplicate_keys(union_all([first, B.build_immigration(t, measures=())]), KEYS)


ODD = " a/b=c%d"


def q_parquet_roundtrip_airports(spark, d):
    """K2 + S5: the airports stored and read back row by row."""
    path = scratch_dir(spark, "airports")
    write_table(airports(spark, d).withColumn("city", F.concat("city", F.lit(ODD))), path)
    return read_back(spark, path, AIRPORT_SCHEMA)


def q_parquet_roundtrip_cities(spark, d):
    """K3 + S5: the city table partitioned by names that hold blanks and the characters of paths, read back row by row."""
    path = scratch_dir(spark, "cities")
    odd = demographics(spark, d).withColumn("city", F.concat("city", F.lit(ODD)))
    write_table(odd, path, DEMOGRAPHICS_PARTITIONS, writers=default_writers(spark))
    return read_back(spark, path, DEMOGRAPHICS_OUT_SCHEMA, DEMOGRAPHICS_PARTITIONS)


def q_parquet_roundtrip(spark, d):
    """K4 + S5: write the temperature table partitioned by (month, city), read it back."""
    path = scratch_dir(spark, "temperature")
    write_table(temperature(spark, d), path, ["month", "city"], writers=default_writers(spark))
    return read_back(spark, path, TEMPERATURE_OUT_SCHEMA, ["month", "city"])


def _stored_fact(spark, d):
    path = scratch_dir(spark, "immigration")
    write_table(fact(spark, d, with_visits=False), path, KEYS, writers=default_writers(spark))
    return read_back(spark, path, IMMIGRATION_SCHEMA, KEYS)


def _maps_long(back):
    """A stored fact's five maps, a row for each entry, and its number of distinct ids as one more row.

    The fact's folders, one for each row, are read once; the maps come from few files with the same rows.
    """
    back = stored(back.hint("rebalance"), "maps")
    maps = [explode_map(back, KEYS, m).select(*KEYS, F.lit(m).alias("measure"), F.col("key").cast("string").alias("key"),
                                              F.col("n").cast("bigint").alias("n")) for m in B.MAP_MEASURES]
    ids = back.agg(F.count_distinct("immigration_id").alias("n")).select(
        F.lit(None).cast("int").alias("month"), F.lit(None).cast("string").alias("airport_cd"),
        F.lit("ids").alias("measure"), F.lit(None).cast("string").alias("key"), "n")
    return union_all([*maps, ids])


def q_parquet_roundtrip_maps(spark, d):
    """K1 + S5: the stored fact's five maps in long form, and its ids."""
    return _maps_long(_stored_fact(spark, d))


def q_parquet_roundtrip_fact(spark, d):
    """K1 + S5: write the fact partitioned by (month, airport_cd), read it back."""
    back = _stored_fact(spark, d)
    return back.select(*KEYS, "avg_stay", "median_age",
                       F.size("gender").alias("n_genders"), F.size("countries").alias("n_countries"))


def _landing(spark, d, start):
    """``start`` (a refresh that stops when all files are read) after the first half-year's files landed, and after the rest."""
    raw = raw_arrivals(spark, d).drop("cicid")
    base = scratch_dir(spark, "stream")
    for name, part in (("batch1", raw.filter(F.col("i94mon") <= 6)),
                       ("batch2", raw.filter(F.coalesce(F.col("i94mon") > 6, F.lit(True))))):
        part.write.parquet(f"{base}/arrivals/{name}")
        start(f"{base}/arrivals", base).awaitTermination()
    return base


def q_stream_refresh_maps(spark, d):
    """The fact's five maps in long form, and its ids, after two refreshes that each read their new files only."""
    from lakemart.streaming import start_merge

    base = _landing(spark, d, lambda src, b: start_merge(spark, src, f"{b}/counts", f"{b}/fact", f"{b}/checkpoint"))
    return _maps_long(read_back(spark, f"{base}/fact", IMMIGRATION_SCHEMA, KEYS))


def q_stable_ids(spark, d):
    """X13 over two refreshes: ids go on from the first one's, which stay."""
    from lakemart.streaming import start_refresh

    base = _landing(spark, d, lambda src, b: start_refresh(spark, src, f"{b}/fact", f"{b}/checkpoint", id_path=f"{b}/ids"))
    return read_back(spark, f"{base}/fact", IMMIGRATION_SCHEMA, KEYS).select(*KEYS, "immigration_id")


def q_stream_refresh(spark, d):
    """Structured Streaming refresh: arrival files land in two batches (months
    1-6, then 7-12, together the whole table); after each, the availableNow
    refresh rebuilds the months it saw.  The stored fact is read back."""
    from lakemart.streaming import start_refresh

    base = _landing(spark, d, lambda src, b: start_refresh(spark, src, f"{b}/fact", f"{b}/checkpoint"))
    back = read_back(spark, f"{base}/fact", IMMIGRATION_SCHEMA, KEYS)
    return back.select(*KEYS, "avg_stay",
                       F.nanvl("median_age", F.lit(None).cast("double")).alias("median_age"),
                       F.size("gender").alias("n_genders"), F.size("countries").alias("n_countries"))


def q_csv_roundtrip(spark, d):
    """S2-S4, S6: ';'-separated gzip CSV in a nested folder, found by glob, typed on read."""
    base = scratch_dir(spark, "csv")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    write_table(c, f"{base}/nested/part", fmt="csv",
                options={"header": "true", "sep": ";", "compression": "gzip"})
    back = read_csv(spark, base, sep=";", recursive=True, glob="*.csv.gz")
    return back.select(X.to_long("c_custkey").alias("c_custkey"), "c_name",
                       X.to_double("c_acctbal").alias("c_acctbal"), "c_mktsegment")


def q_union_csv(spark, d):
    """One folder of plain comma CSV in three layouts (columns in another order, more of them, one more
    first), quoted cells; read in one call, by name."""
    base = scratch_dir(spark, "layouts")
    c = table(spark, d, "customer").select(
        "c_custkey", F.concat("c_name", F.lit(", "), "c_mktsegment").alias("label"), "c_acctbal", "c_nationkey")
    debt = F.coalesce(F.col("c_acctbal") < 0, F.lit(False))
    rich = F.coalesce(F.col("c_acctbal") > 5000, F.lit(False))
    for name, part in (("a", c.filter(debt).drop("c_nationkey")),
                       ("b", c.filter(~debt & ~rich).select("c_nationkey", "c_acctbal", "label", "c_custkey")),
                       ("c", c.filter(~debt & rich).select(F.lit("x,y").alias("extra"), "label", "c_custkey", "c_acctbal"))):
        write_table(part, f"{base}/{name}", fmt="csv", options={"header": "true"})
    back = read_csv_by_name(spark, base, ["c_custkey", "label", "c_acctbal"], recursive=True)
    return back.select(X.to_long("c_custkey").alias("c_custkey"), "label", X.to_double("c_acctbal").alias("c_acctbal"))


def q_raw_null_counts(spark, d):
    """Q1 over the raw arrivals."""
    return Q.null_counts(raw_arrivals(spark, d))


def q_raw_null_counts_temperature(spark, d):
    """Q1 over the raw temperatures."""
    return Q.null_counts(raw_temperature(spark, d))


def q_type_check(spark, d):
    """Q5: the stored type of a column against the expected one, beside the rows it holds for."""
    t = temperature(spark, d)
    actual = t.schema["median_avg_temp"].dataType
    expected = TEMPERATURE_OUT_SCHEMA["median_avg_temp"].dataType
    return t.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("median_avg_temp").alias("column_name"), F.lit(expected.simpleString()).alias("expected"),
        F.lit(actual.simpleString()).alias("actual"),
        F.lit(Q.has_type(t, "median_avg_temp", expected)).alias("ok"), "n_rows")


def q_airport_dim_strict(spark, d):
    """M2 with code and city required."""
    return B.build_airports(raw_airports(spark, d), require_iata=True, require_city=True)


def q_dup_trip_keys(spark, d):
    """Q2 on rows that do repeat their keys: the cleaned rows."""
    return Q.duplicate_keys(trips(spark, d), KEYS)


def q_pipeline_all(spark, d):
    """M5: the four sources written as files, built, stored (K1-K4) and read back."""
    base = scratch_dir(spark, "mart")
    write_table(raw_arrivals(spark, d).drop("cicid"), f"{base}/arrivals")
    for name, raw, sep in (("airports", raw_airports, ","), ("cities", raw_demographics, ";"),
                           ("temperatures", raw_temperature, ",")):
        write_table(raw(spark, d), f"{base}/{name}", fmt="csv", options={"header": "true", "sep": sep})
    P.run(spark, P.Sources(f"{base}/arrivals", f"{base}/airports", f"{base}/cities", f"{base}/temperatures"),
          f"{base}/out")
    n_rows = F.count(F.lit(1)).alias("n_rows")
    airlines = F.aggregate(F.map_values("airlines"), F.lit(0).cast("bigint"), lambda acc, n: acc + n)
    checks = {"immigration": (F.count_distinct("immigration_id"), F.sum(airlines)),
              "airports": (F.count_distinct("city"), F.count("airport_cd")),
              "demographics": (F.count_distinct("city", "state"), F.sum("white_pop")),
              "temperature": (F.count_distinct("city"), F.sum("month"))}
    return union_all([
        read_output(spark, f"{base}/out", name).agg(n_rows, keys.alias("n_keys"), total.cast("bigint").alias("total"))
        .select(F.lit(name).alias("table_name"), "n_rows", "n_keys", "total")
        for name, (keys, total) in checks.items()])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_trips": q_clean_trips,
    "group_count": q_group_count,
    "avg_stay": q_avg_stay,
    "median_age": q_median_age,
    "approx_median_age": q_approx_median_age,
    "count_map_gender": _count_map_query("gender"),
    "count_map_trip": _count_map_query("trip_purpose"),
    "count_map_visa": _count_map_query("visa_type"),
    "count_map_countries": _count_map_query("countries"),
    "count_map_airlines": _count_map_query("airlines"),
    "fact_wide": q_fact_wide,
    "join_measures": q_join_measures,
    "surrogate_id": q_surrogate_id,
    "sas_date": q_sas_date,
    "map_codes": q_map_codes,
    "null_if": q_null_if,
    "split_get": q_split_get,
    "try_casts": q_try_casts,
    "parse_dates": q_parse_dates,
    "c_to_f": q_c_to_f,
    "signed_coord": q_signed_coord,
    "like_filter": q_like_filter,
    "null_drop": q_null_drop,
    "pivot_sum": q_pivot_sum,
    "pivot_join": q_pivot_join,
    "distinct_median": q_distinct_median,
    "airport_dim": q_airport_dim,
    "union_files": q_union_files,
    "null_counts": q_null_counts,
    "dup_keys": q_dup_keys,
    "dup_fact_keys": q_dup_fact_keys,
    "distinct_count": q_distinct_count,
    "join_coverage": q_join_coverage,
    "profile": q_profile,
    "max_year": q_max_year,
    "categories": q_categories,
    "snowflake_join": q_snowflake_join,
    "pivot_gender": q_pivot_gender,
    "pivot_trip": q_pivot_trip,
    "avg_age": q_avg_age,
    "parquet_roundtrip": q_parquet_roundtrip,
    "parquet_roundtrip_fact": q_parquet_roundtrip_fact,
    "parquet_roundtrip_maps": q_parquet_roundtrip_maps,
    "csv_roundtrip": q_csv_roundtrip,
    "stream_refresh": q_stream_refresh,
    "stream_refresh_maps": q_stream_refresh_maps,
    "union_csv": q_union_csv,
    "raw_null_counts": q_raw_null_counts,
    "raw_null_counts_temperature": q_raw_null_counts_temperature,
    "type_check": q_type_check,
    "airport_dim_strict": q_airport_dim_strict,
    "dup_trip_keys": q_dup_trip_keys,
    "pipeline_all": q_pipeline_all,
    "hot_median": q_hot_median,
    "snowflake_by_place": q_snowflake_by_place,
    "stable_ids": q_stable_ids,
    "join_measures_bucketed": q_join_measures_bucketed,
    "pruned_join": q_pruned_join,
    "dup_refresh_keys": q_dup_refresh_keys,
    "parquet_roundtrip_airports": q_parquet_roundtrip_airports,
    "parquet_roundtrip_cities": q_parquet_roundtrip_cities,
}
