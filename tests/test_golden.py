"""Golden rows per builder (hand-worked inputs from FIXTURES.md)."""

import math

from pyspark.sql import Row
from pyspark.sql import types as T

from lakemart.plans import builders as B
from lakemart.sources.schemas import ARRIVALS_SCHEMA, IMMIGRATION_SCHEMA

ARRIVALS = [
    (4, 111, "ATL", 20574, 20580, 1, 30, 2, "M", "DL", "WT"),
    (4, 111, "ATL", 20574, 20580, 1, 30, 2, "M", "DL", "WT"),
    (4, 111, "ATL", 20574, 20577, 1, 41, 1, "X", "DL", "B1"),
    (4, 209, "ATL", 20574, None, 1, None, 4, "F", None, "WT"),
    (4, 209, "ATL", 20570, 20580, 2, 50, 2, "M", "AA", "WT"),
    (4, 209, "XXX", 20570, 20580, 1, 50, 2, "M", "AA", "WT"),
    (4, 209, None, 20570, 20580, 1, 50, 2, "M", "AA", "WT"),
    (5, 245, "SFR", 20580, None, 1, None, 3, None, None, "F1"),
    (5, 245, "SFR", 20580, 20590, None, 20, 3, "F", "UA", "F1"),
]


def _arrivals(spark):
    rows = [tuple(float(v) if isinstance(v, int) else v for v in r) for r in ARRIVALS]
    return spark.createDataFrame(rows, ARRIVALS_SCHEMA)


def test_clean_arrivals(spark):
    clean = B.clean_arrivals(_arrivals(spark))
    rows = sorted(clean.collect(), key=lambda r: (r.month, r.country_id, r.visa_type, r.age or 0))
    assert len(rows) == 4
    atl = [r for r in rows if r.airport_cd == "ATL"]
    stays = sorted([r.length_of_stay for r in atl if r.length_of_stay is not None])
    assert stays == [3, 6]
    assert {r.trip_purpose for r in atl} == {"Business", "Pleasure", None}
    assert {r.gender for r in atl} == {"M", None, "F"}


def test_immigration_fact(spark):
    fact = B.build_immigration(B.clean_arrivals(_arrivals(spark)), with_visits=True)
    assert [f.name for f in fact.schema.fields][:9] == [f.name for f in IMMIGRATION_SCHEMA.fields][:9]
    for f in IMMIGRATION_SCHEMA.fields:
        assert fact.schema[f.name].dataType.simpleString() == f.dataType.simpleString(), f.name
    got = {(r.month, r.airport_cd): r for r in fact.collect()}
    atl = got[(4, "ATL")]
    assert atl.visits == 3
    assert atl.gender == {"F": 1, "M": 1}
    assert atl.avg_stay == 4.5
    assert atl.median_age == 35.5
    assert atl.trip_purpose == {"Business": 1, "Pleasure": 1}
    assert atl.visa_type == {"B1": 1, "WT": 2}
    assert atl.countries == {111: 2, 209: 1}
    assert atl.airlines == {"DL": 2}
    sfr = got[(5, "SFR")]
    assert sfr.visits == 1
    assert sfr.gender == {}
    assert sfr.avg_stay is None
    assert math.isnan(sfr.median_age)
    assert sfr.trip_purpose == {"Student": 1}
    assert sfr.visa_type == {"F1": 1}
    assert sfr.countries == {245: 1}
    assert sfr.airlines == {}
    ids = [r.immigration_id for r in got.values()]
    assert len(set(ids)) == len(ids)


def test_immigration_null_median_mode(spark):
    fact = B.build_immigration(B.clean_arrivals(_arrivals(spark)), empty_median="null")
    sfr = fact.filter("airport_cd = 'SFR'").first()
    assert sfr.median_age is None


def test_airports(spark):
    cols = ["iata_code", "type", "name", "iso_country", "iso_region", "municipality", "coordinates"]
    data = [
        ("ATL", "large_airport", "Big", "US", "US-GA", "Atlanta", "-84.42, 33.63"),
        ("ATL", "large_airport", "Big", "US", "US-GA", "Atlanta", "-84.42, 33.63"),
        (None, "small_airport", "Strip", "US", "US-AK", "Nome", "-165.4, 64.5"),
        ("NOC", "small_airport", "Bare", "US", "US-PR", None, "-66.0, 18.4"),
        ("REG", "small_airport", "Odd", "US", "US", "Reg", "10.0"),
        ("XHP", "heliport", "Pad", "US", "US-NY", "New York", "-74.0, 40.7"),
        ("LHR", "large_airport", "Far", "GB", "GB-ENG", "London", "-0.46, 51.47"),
    ]
    raw = spark.createDataFrame(data, T.StructType([T.StructField(c, T.StringType()) for c in cols]))
    out = {r.name: r for r in B.build_airports(raw).collect()}
    assert set(out) == {"Big", "Strip", "Bare", "Odd"}
    assert out["Big"] == Row(airport_cd="ATL", type="large_airport", name="Big", state="GA",
                             city="Atlanta", latitude=33.63, longitude=-84.42)
    assert out["Odd"].state is None and out["Odd"].latitude is None and out["Odd"].longitude == 10.0
    strict = {r.name for r in B.build_airports(raw, require_iata=True, require_city=True).collect()}
    assert strict == {"Big", "Odd"}


def test_demographics(spark):
    cols = ["City", "State Code", "Median Age", "Male Population", "Female Population",
            "Total Population", "Number of Veterans", "Foreign-born", "Average Household Size",
            "Race", "Count"]
    data = [
        ("Allen", "PA", "33.5", "60626", "59581", "120207", "5691", "19652", "2.67", "White", "100"),
        ("Allen", "PA", "33.5", "60626", "59581", "120207", "5691", "19652", "2.67", "Hispanic or Latino", "50"),
        ("Allen", "TX", "37.2", "46000", "47000", "93000", "4000", "18000", "3.1", "White", "70"),
        ("Bare", "ZZ", None, None, None, None, None, None, None, "Asian", "5"),
    ]
    raw = spark.createDataFrame(data, T.StructType([T.StructField(c, T.StringType()) for c in cols]))
    out = B.build_demographics(raw)
    assert "total_pop" not in out.columns
    got = {(r.city, r.state): r for r in out.collect()}
    assert len(got) == 3
    pa = got[("Allen", "PA")]
    assert (pa.white_pop, pa.hispanic_pop, pa.asian_pop, pa.native_am_pop, pa.black_pop) == (100, 50, None, None, None)
    assert pa.median_age == 33.5 and pa.male_pop == 60626 and pa.avg_hh_size == 2.67
    assert got[("Allen", "TX")].white_pop == 70
    bare = got[("Bare", "ZZ")]
    assert bare.asian_pop == 5 and bare.median_age is None and bare.male_pop is None


def test_temperature(spark):
    cols = ["dt", "AverageTemperature", "City", "Country", "Latitude", "Longitude"]
    us = ("Akron", "United States", "40.99N", "80.95W")
    data = [
        ("1949-12-01", "5.0", *us),
        ("1950-01-01", "0.0", *us),
        ("1951-01-01", "0.0", *us),
        ("1952-01-01", "10.0", *us),
        ("1953-01-01", "20.0", *us),
        ("1954-01-01", None, *us),
        ("1955-01-01", "-40.0", *us),
        ("1950-02-01", "3.333", *us),
        ("1950-01-01", "15.0", "Paris", "France", "48.85N", "2.35E"),
    ]
    raw = spark.createDataFrame(data, T.StructType([T.StructField(c, T.StringType()) for c in cols]))
    got = sorted(B.build_temperature(raw).collect())
    assert got == [
        Row(month=1, city="Akron", latitude=40.99, longitude=-80.95, median_avg_temp=41.0),
        Row(month=2, city="Akron", latitude=40.99, longitude=-80.95, median_avg_temp=38.0),
    ]


def test_signed_coordinate(spark):
    from lakemart.functions.columns import signed_coordinate

    df = spark.createDataFrame([("12.5n",), ("12.5s",), ("12.5X",), (None,), ("",), ("abN",), ("7e",)], "c string")
    got = [r.v for r in df.select(signed_coordinate("c").alias("v")).collect()]
    assert got == [12.5, -12.5, None, None, None, None, 7.0]


def test_text_arrivals_equal_numeric(spark):
    # the CSV sample form: every column text, numbers written like '4.0'
    from lakemart.sources.schemas import ARRIVALS_TEXT_SCHEMA

    text_rows = [tuple(None if v is None else (f"{float(v)}" if isinstance(v, int) else v) for v in r)
                 for r in ARRIVALS]
    text = spark.createDataFrame(text_rows, ARRIVALS_TEXT_SCHEMA)
    cols = ["month", "airport_cd", "avg_stay", "median_age"]
    a = B.build_immigration(B.clean_arrivals(text), empty_median="null").select(*cols, "countries")
    b = B.build_immigration(B.clean_arrivals(_arrivals(spark)), empty_median="null").select(*cols, "countries")
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
