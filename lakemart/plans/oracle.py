"""DuckDB SQL for every contract query (same column names and types).

Written independently of the Spark side: the analogue inputs are re-derived
from the base tables in SQL.  Two helpers keep the comparisons exact:

* ``_round2``: Spark rounds a double HALF_UP on its shortest decimal text;
  going through ``DECIMAL(38,10)`` does the same in DuckDB (its ``round`` on
  doubles works on the binary value).
* ``_median``: exact median as ``(lo + hi) / 2`` of the middle rows, which is
  bit-equal to Spark's ``0.5*lo + 0.5*hi``.
"""

from __future__ import annotations


def _round2(expr: str) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), 2) AS DOUBLE)"


def _median(src: str, keys: list[str], value: str, out: str) -> str:
    k = ", ".join(keys)
    return (
        f"SELECT {k}, (max(v) FILTER (WHERE rn = (cnt + 1) // 2) + max(v) FILTER (WHERE rn = cnt // 2 + 1)) / 2 AS {out} "
        f"FROM (SELECT {k}, CAST({value} AS DOUBLE) AS v, "
        f"row_number() OVER (PARTITION BY {k} ORDER BY {value}) AS rn, "
        f"count(*) OVER (PARTITION BY {k}) AS cnt FROM {src} WHERE {value} IS NOT NULL) GROUP BY {k}"
    )


RAW_ARRIVALS = """
raw_arrivals AS (
  SELECT l_orderkey * 8 + l_linenumber AS cicid,
         CAST(month(l_shipdate) AS DOUBLE) AS i94mon,
         CAST(c_nationkey AS DOUBLE) AS i94cit,
         CASE WHEN p_type = 'ECONOMY' THEN 'XXX' ELSE CAST(l_suppkey AS VARCHAR) END AS i94port,
         CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS arrdate,
         CASE WHEN l_returnflag = 'R' THEN NULL
              ELSE CAST(date_diff('day', DATE '1960-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) END AS depdate,
         CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 2.0 END AS i94mode,
         CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity END AS i94bir,
         CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS i94visa,
         CASE WHEN (l_suppkey + month(l_shipdate)) % 7 = 0 THEN NULL WHEN l_returnflag = 'N' THEN 'X'
              ELSE l_returnflag END AS gender,
         p_brand AS airline,
         c_mktsegment AS visatype
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
)"""

TRIPS = RAW_ARRIVALS + """,
typed AS (
  SELECT DISTINCT CAST(i94mon AS INTEGER) AS month, CAST(i94cit AS INTEGER) AS country_id,
         i94port AS airport_cd, CAST(arrdate AS INTEGER) AS arrival_date,
         CAST(depdate AS INTEGER) AS departure_date, CAST(i94bir AS INTEGER) AS age,
         CAST(i94visa AS INTEGER) AS trip_purpose, gender, airline AS airline_cd, visatype AS visa_type
  FROM raw_arrivals
  WHERE i94mode = 1 AND i94port NOT IN ('XXX', '888', 'UNK')
),
trips AS (
  SELECT month, country_id, airport_cd, age,
         CASE trip_purpose WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure' WHEN 3 THEN 'Student' END AS trip_purpose,
         NULLIF(gender, 'X') AS gender, airline_cd, visa_type,
         CAST(departure_date - arrival_date AS INTEGER) AS length_of_stay
  FROM typed
)"""

FACT = TRIPS + f""",
fact_groups AS (
  SELECT month, airport_cd, count(*) AS visits,
         {_round2('avg(length_of_stay)')} AS avg_stay,
         CAST(count(DISTINCT gender) AS INTEGER) AS n_genders,
         CAST(count(DISTINCT trip_purpose) AS INTEGER) AS n_trip_purposes,
         CAST(count(DISTINCT visa_type) AS INTEGER) AS n_visa_types,
         CAST(count(DISTINCT country_id) AS INTEGER) AS n_countries,
         CAST(count(DISTINCT airline_cd) AS INTEGER) AS n_airlines
  FROM trips GROUP BY month, airport_cd
),
fact_median AS ({_median('trips', ['month', 'airport_cd'], 'age', 'median_age')}),
fact AS (
  SELECT g.month, g.airport_cd, g.visits, g.avg_stay, m.median_age, g.n_genders, g.n_trip_purposes,
         g.n_visa_types, g.n_countries, g.n_airlines
  FROM fact_groups g LEFT JOIN fact_median m
    ON g.month IS NOT DISTINCT FROM m.month AND g.airport_cd = m.airport_cd
)"""

AIRPORTS = """
raw_airports AS (
  SELECT CASE WHEN s_acctbal < 0 THEN NULL ELSE CAST(s_suppkey AS VARCHAR) END AS iata_code,
         CASE WHEN s_acctbal BETWEEN 0 AND 999.99 THEN 'heliport' WHEN s_acctbal < 5000 THEN 'small_airport'
              ELSE 'large_airport' END AS type,
         s_name AS name,
         CASE WHEN n_regionkey = 3 THEN 'GB' ELSE 'US' END AS iso_country,
         CASE WHEN n_regionkey = 4 THEN NULL ELSE 'R' || CAST(n_regionkey AS VARCHAR) END AS state,
         n_name AS city,
         CAST(n_nationkey AS DOUBLE) + 0.5 AS latitude,
         s_acctbal / 100 AS longitude
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
airports AS (
  SELECT DISTINCT iata_code AS airport_cd, type, name, state, city, latitude, longitude
  FROM raw_airports WHERE iso_country = 'US' AND type LIKE '%airport%'
)"""

_RACE_SEGMENTS = [
    ("native_am_pop", "AUTOMOBILE"),
    ("asian_pop", "BUILDING"),
    ("black_pop", "FURNITURE"),
    ("hispanic_pop", "HOUSEHOLD"),
    ("white_pop", "MACHINERY"),
]
_RACE_SUMS = ",\n         ".join(
    f"CAST(sum(cnt) FILTER (WHERE segment = '{seg}') AS INTEGER) AS {col}" for col, seg in _RACE_SEGMENTS)

DEMOGRAPHICS = f"""
raw_demo AS (
  SELECT n_name AS city,
         CASE WHEN n_regionkey = 4 THEN NULL ELSE 'R' || CAST(n_regionkey AS VARCHAR) END AS state,
         CAST(n_nationkey AS DOUBLE) + 20.5 AS median_age,
         CAST(n_nationkey * 1000 AS INTEGER) AS male_pop,
         CAST(n_nationkey * 1100 + 7 AS INTEGER) AS female_pop,
         CAST(n_nationkey * 10 AS INTEGER) AS veterans,
         CAST(n_regionkey AS INTEGER) AS foreign_born,
         CAST(n_regionkey AS DOUBLE) + 1.25 AS avg_hh_size,
         c_mktsegment AS segment,
         trunc(c_acctbal) AS cnt
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
demo_city AS (
  SELECT DISTINCT city, state, median_age, male_pop, female_pop, veterans, foreign_born, avg_hh_size FROM raw_demo
),
demo_race AS (
  SELECT city, state,
         {_RACE_SUMS}
  FROM raw_demo GROUP BY city, state
),
demographics AS (
  SELECT c.city, c.state, c.median_age, c.male_pop, c.female_pop, r.native_am_pop, r.asian_pop,
         r.black_pop, r.hispanic_pop, r.white_pop, c.veterans, c.foreign_born, c.avg_hh_size
  FROM demo_city c JOIN demo_race r ON c.city = r.city AND c.state = r.state
)"""

TEMPERATURE = f"""
raw_temp AS (
  SELECT CAST(year(l_shipdate) - 47 AS INTEGER) AS yr,
         CAST(month(l_shipdate) AS INTEGER) AS mon,
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_quantity - 20 + l_discount * 10 END AS celsius,
         n_name AS city,
         CASE WHEN n_regionkey = 2 THEN 'France' ELSE 'United States' END AS country,
         CASE WHEN n_nationkey < 12 THEN CAST(n_nationkey AS DOUBLE) + 10.5
              ELSE -(CAST(n_nationkey AS DOUBLE) + 10.5) END AS latitude,
         -(CAST(n_regionkey * 20 AS DOUBLE) + 0.25) AS longitude
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
),
temp_rows AS (
  SELECT DISTINCT mon AS month, {_round2('celsius * CAST(1.8 AS DOUBLE) + 32')} AS avg_temp,
         city, latitude, longitude
  FROM raw_temp WHERE country = 'United States' AND yr >= 1950 AND celsius IS NOT NULL
),
temperature AS ({_median('temp_rows', ['month', 'city', 'latitude', 'longitude'], 'avg_temp', 'median_avg_temp')})"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes) + "\n"


def _count_map(col: str) -> str:
    return _with(TRIPS) + (
        f"SELECT month, airport_cd, {col} AS key, CAST(count(*) AS INTEGER) AS n "
        f"FROM trips WHERE {col} IS NOT NULL GROUP BY month, airport_cd, {col}")


def _maps_long() -> str:
    maps = [("gender", "gender"), ("trip_purpose", "trip_purpose"), ("visa_type", "visa_type"),
            ("countries", "country_id"), ("airlines", "airline_cd")]
    return _with(FACT) + "".join(
        f"SELECT month, airport_cd, '{m}' AS measure, CAST({c} AS VARCHAR) AS key, count(*) AS n "
        f"FROM trips WHERE {c} IS NOT NULL GROUP BY month, airport_cd, {c} UNION ALL " for m, c in maps) + (
        "SELECT NULL, NULL, 'ids', NULL, count(*) FROM fact")


_TRIP_COLUMNS = [("month", "int"), ("country_id", "int"), ("airport_cd", "string"), ("age", "int"),
                 ("trip_purpose", "string"), ("gender", "string"), ("airline_cd", "string"),
                 ("visa_type", "string"), ("length_of_stay", "int")]

FACT_KEYS_DISTINCT = "(SELECT DISTINCT month, airport_cd FROM trips)"

SQL: dict[str, str] = {
    "clean_trips": _with(TRIPS) + "SELECT * FROM trips",
    "group_count": _with(TRIPS) + "SELECT month, airport_cd, count(*) AS n FROM trips GROUP BY month, airport_cd",
    "avg_stay": _with(TRIPS) + (
        f"SELECT month, airport_cd, {_round2('avg(length_of_stay)')} AS avg_stay "
        "FROM trips GROUP BY month, airport_cd"),
    "median_age": _with(TRIPS) + (
        "SELECT g.month, g.airport_cd, m.median_age FROM " + FACT_KEYS_DISTINCT + " g "
        "LEFT JOIN (" + _median("trips", ["month", "airport_cd"], "age", "median_age") + ") m "
        "ON g.month IS NOT DISTINCT FROM m.month AND g.airport_cd = m.airport_cd"),
    "approx_median_age": _with(TRIPS) + (
        "SELECT month, airport_cd, quantile_disc(age, 0.5) AS approx_median_age "
        "FROM trips GROUP BY month, airport_cd"),
    "count_map_gender": _count_map("gender"),
    "count_map_trip": _count_map("trip_purpose"),
    "count_map_visa": _count_map("visa_type"),
    "count_map_countries": _count_map("country_id"),
    "count_map_airlines": _count_map("airline_cd"),
    "fact_wide": _with(FACT) + "SELECT * FROM fact",
    "join_measures": _with(FACT) + "SELECT month, airport_cd, visits, avg_stay, median_age FROM fact",
    "surrogate_id": _with(TRIPS) + f"SELECT count(*) AS n_rows, count(*) AS n_ids FROM {FACT_KEYS_DISTINCT}",
    "sas_date": "SELECT o_orderkey, CAST(DATE '1960-01-01' + CAST(o_custkey AS INTEGER) AS DATE) AS sas_date FROM orders",
    "map_codes": (
        "SELECT o_orderkey, CASE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) WHEN 1 THEN 'Business' "
        "WHEN 2 THEN 'Pleasure' WHEN 3 THEN 'Student' END AS trip_purpose FROM orders"),
    "null_if": "SELECT l_orderkey, l_linenumber, NULLIF(l_returnflag, 'N') AS flag FROM lineitem",
    "split_get": (
        "SELECT p_partkey, string_split(p_name, ' ')[1] AS word0, string_split(p_name, ' ')[2] AS word1, "
        "string_split(p_name, ' ')[3] AS word2, string_split(p_brand, '#')[2] AS brand_no FROM part"),
    "try_casts": (
        "SELECT p_partkey, TRY_CAST(string_split(p_brand, '#')[2] AS INTEGER) AS brand_no, "
        "p_retailprice AS price, CAST(trunc(p_retailprice) AS INTEGER) AS price_int, "
        "TRY_CAST(p_name AS DOUBLE) AS bad_number FROM part"),
    "parse_dates": (
        "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, CAST(NULL AS DATE) AS bad_date, "
        "CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(month(o_orderdate) AS INTEGER) AS mon "
        "FROM orders WHERE year(o_orderdate) >= 1998"),
    "c_to_f": f"SELECT p_partkey, {_round2('p_size * CAST(1.8 AS DOUBLE) + 32')} AS temp_f FROM part",
    "signed_coord": (
        "SELECT s_suppkey, CASE WHEN s_nationkey = 0 THEN NULL "
        "WHEN s_nationkey BETWEEN 5 AND 9 OR s_nationkey BETWEEN 15 AND 19 THEN -s_acctbal "
        "WHEN s_nationkey < 15 THEN s_acctbal END AS coord FROM supplier"),
    "like_filter": (
        "SELECT p_partkey, p_name, p_type, p_brand FROM part "
        "WHERE p_type LIKE '%M%' AND p_brand = 'Brand#2'"),
    "null_drop": (
        "SELECT l_orderkey, l_linenumber, NULLIF(l_returnflag, 'N') AS flag, CAST(NULL AS VARCHAR) AS status "
        "FROM lineitem WHERE l_returnflag <> 'N' AND l_linestatus = 'O'"),
    "pivot_sum": "SELECT c_nationkey, " + ", ".join(
        f"CAST(sum(trunc(c_acctbal)) FILTER (WHERE c_mktsegment = '{seg}') AS BIGINT) AS {seg.lower()}"
        for seg in ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    ) + " FROM customer GROUP BY c_nationkey",
    "pivot_join": _with(DEMOGRAPHICS) + "SELECT * FROM demographics",
    "distinct_median": _with(TEMPERATURE) + "SELECT * FROM temperature",
    "airport_dim": _with(AIRPORTS) + "SELECT * FROM airports",
    "union_files": "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem",
    "null_counts": _with(TRIPS) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM trips" for c, _ in _TRIP_COLUMNS),
    "dup_keys": _with(TRIPS) + (
        f"SELECT count(*) AS duplicate_keys FROM (SELECT airport_cd FROM {FACT_KEYS_DISTINCT} "
        "GROUP BY airport_cd HAVING count(*) >= 2)"),
    "dup_fact_keys": _with(TRIPS) + (
        f"SELECT count(*) AS duplicate_keys FROM (SELECT month, airport_cd FROM {FACT_KEYS_DISTINCT} "
        "GROUP BY month, airport_cd HAVING count(*) >= 2)"),
    "distinct_count": _with(TRIPS) + (
        "SELECT count(*) AS distinct_count, count(*) = 12 AS as_expected FROM (SELECT DISTINCT month FROM trips)"),
    "join_coverage": _with(TRIPS, AIRPORTS) + (
        f"SELECT count(*) AS matched FROM {FACT_KEYS_DISTINCT} t "
        "WHERE t.airport_cd IN (SELECT airport_cd FROM airports)"),
    "profile": _with(TRIPS) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null FROM trips" for c, t in _TRIP_COLUMNS),
    "max_year": _with(TEMPERATURE) + "SELECT max(yr) AS max_year FROM raw_temp WHERE country = 'United States'",
    "categories": _with(AIRPORTS) + "SELECT DISTINCT type FROM raw_airports",
    "snowflake_join": _with(FACT, AIRPORTS, DEMOGRAPHICS, TEMPERATURE) + """
SELECT a.city, f.month, f.airport_cd, f.avg_stay, f.median_age, a.state,
       a.name AS airport_name, a.type AS airport_type,
       d.male_pop, d.female_pop, d.native_am_pop, d.asian_pop, d.black_pop, d.hispanic_pop, d.white_pop,
       d.veterans, d.foreign_born, d.avg_hh_size AS avg_household_size, t.median_avg_temp
FROM fact f
JOIN airports a ON f.airport_cd = a.airport_cd
LEFT JOIN demographics d ON a.city = d.city AND a.state = d.state
LEFT JOIN temperature t ON a.city = t.city AND f.month = t.month""",
    "pivot_gender": _with(RAW_ARRIVALS) + """
SELECT CAST(i94mon AS INTEGER) AS month, i94port AS airport_cd,
       count(DISTINCT cicid) FILTER (WHERE gender = 'A') AS n_a,
       count(DISTINCT cicid) FILTER (WHERE gender = 'R') AS n_r
FROM raw_arrivals WHERE i94mode = 1 AND i94port NOT IN ('XXX', '888', 'UNK') AND gender IS NOT NULL
GROUP BY CAST(i94mon AS INTEGER), i94port""",
    "pivot_trip": _with(TRIPS) + """
SELECT month, airport_cd,
       count(trip_purpose) FILTER (WHERE trip_purpose = 'Business') AS business,
       count(trip_purpose) FILTER (WHERE trip_purpose = 'Pleasure') AS pleasure,
       count(trip_purpose) FILTER (WHERE trip_purpose = 'Student') AS student
FROM trips GROUP BY month, airport_cd""",
    "avg_age": _with(TRIPS) + f"SELECT month, airport_cd, {_round2('avg(age)')} AS avg_age FROM trips GROUP BY month, airport_cd",
    "parquet_roundtrip": _with(TEMPERATURE) + "SELECT * FROM temperature",
    "parquet_roundtrip_fact": _with(FACT) + (
        "SELECT month, airport_cd, avg_stay, median_age, n_genders, n_countries FROM fact"),
    "parquet_roundtrip_maps": _maps_long(),
    "stream_refresh_maps": _maps_long(),
    "csv_roundtrip": "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer",
    "stream_refresh": _with(FACT) + (
        "SELECT month, airport_cd, avg_stay, median_age, n_genders, n_countries FROM fact"),
    "union_csv": "SELECT c_custkey, c_name || ', ' || c_mktsegment AS label, c_acctbal FROM customer",
    "raw_null_counts": _with(RAW_ARRIVALS) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM raw_arrivals"
        for c in ["cicid", "i94mon", "i94cit", "i94port", "arrdate", "depdate", "i94mode", "i94bir", "i94visa",
                  "gender", "airline", "visatype"]),
    "raw_null_counts_temperature": _with(TEMPERATURE) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({e}) AS null_count FROM raw_temp"
        for c, e in [("dt", "yr"), ("AverageTemperature", "celsius"), ("City", "city"), ("Country", "country"),
                     ("Latitude", "latitude"), ("Longitude", "longitude")]),
    "type_check": _with(TEMPERATURE) + (
        "SELECT 'median_avg_temp' AS column_name, 'double' AS expected, "
        "lower(max(typeof(median_avg_temp))) AS actual, max(typeof(median_avg_temp)) = 'DOUBLE' AS ok, "
        "count(*) AS n_rows FROM temperature"),
    "airport_dim_strict": _with(AIRPORTS) + (
        "SELECT * FROM airports WHERE airport_cd IS NOT NULL AND city IS NOT NULL"),
    "dup_trip_keys": _with(TRIPS) + (
        "SELECT count(*) AS duplicate_keys FROM (SELECT month, airport_cd FROM trips "
        "GROUP BY month, airport_cd HAVING count(*) >= 2)"),
    "pipeline_all": _with(FACT, AIRPORTS, DEMOGRAPHICS, TEMPERATURE) + """
SELECT 'immigration' AS table_name, count(*) AS n_rows, count(*) AS n_keys,
       (SELECT count(airline_cd) FROM trips) AS total FROM fact
UNION ALL SELECT 'airports', count(*), count(DISTINCT city), count(airport_cd) FROM airports
UNION ALL SELECT 'demographics', count(*), count(DISTINCT (city, state)), CAST(sum(white_pop) AS BIGINT) FROM demographics
UNION ALL SELECT 'temperature', count(*), count(DISTINCT city), CAST(sum(month) AS BIGINT) FROM temperature""",
    "hot_median": (
        "WITH x AS (SELECT CASE WHEN l_linenumber <= 2 THEN 0 WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS grp, "
        "l_extendedprice * CAST(1000003 AS DOUBLE) + CAST(l_orderkey * 8 + l_linenumber AS DOUBLE) AS v FROM lineitem) "
        + _median("x", ["grp"], "v", "median_v")),
    "snowflake_by_place": _with(FACT, AIRPORTS, TEMPERATURE) + """,
a AS (SELECT airport_cd, substr(city, 1, 1) AS city, latitude, longitude FROM airports WHERE airport_cd IS NOT NULL),
t AS (SELECT month, substr(city, 1, 1) AS city, latitude, longitude, median_avg_temp FROM temperature),
near AS (SELECT airport_cd, p.latitude, p.longitude FROM a JOIN (SELECT DISTINCT city, latitude, longitude FROM t) p USING (city)
  QUALIFY row_number() OVER (PARTITION BY airport_cd ORDER BY (a.latitude - p.latitude) * (a.latitude - p.latitude)
    + least(abs(a.longitude - p.longitude), 360 - abs(a.longitude - p.longitude))
      * least(abs(a.longitude - p.longitude), 360 - abs(a.longitude - p.longitude)), p.latitude, p.longitude) = 1)
SELECT f.month, f.airport_cd, a.city, f.avg_stay, t.median_avg_temp
FROM fact f JOIN a ON f.airport_cd = a.airport_cd LEFT JOIN near n ON n.airport_cd = a.airport_cd
LEFT JOIN t ON t.city = a.city AND t.month = f.month AND t.latitude = n.latitude AND t.longitude = n.longitude""",
    "stable_ids": _with(TRIPS) + (
        "SELECT month, airport_cd, row_number() OVER (ORDER BY coalesce(month > 6, true), month NULLS FIRST, airport_cd) - 1 "
        f"AS immigration_id FROM {FACT_KEYS_DISTINCT}"),
    "join_measures_bucketed": _with(FACT) + "SELECT month, airport_cd, visits, avg_stay, median_age FROM fact",
    "pruned_join": _with(FACT, AIRPORTS) + (
        "SELECT f.month, f.airport_cd, a.city, f.avg_stay FROM fact f JOIN airports a ON f.airport_cd = a.airport_cd WHERE a.state = 'R1'"),
    "dup_refresh_keys": _with(TRIPS) + f"SELECT count(*) AS duplicate_keys FROM {FACT_KEYS_DISTINCT} WHERE month <= 6",
    "parquet_roundtrip_airports": _with(AIRPORTS) + "SELECT * REPLACE (city || ' a/b=c%d' AS city) FROM airports",
    "parquet_roundtrip_cities": _with(DEMOGRAPHICS) + "SELECT * REPLACE (city || ' a/b=c%d' AS city) FROM demographics",
}
