"""Table builders (M1a, M1-M4): pure DataFrame -> DataFrame functions.

No builder triggers a job or caches anything; the sink (or a check) is the
action.  Deduplication happens exactly where the original job placed it,
because the order changes the result (see the notes on each builder).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import columns as X
from lakemart.operators.aggregates import Measures, distinct_median, exact_median, rounded_mean, row_count
from lakemart.operators.selection import selected_median

# The fact's keys, its map columns with their sources and key types, and its columns in order.
FACT_KEYS = ["month", "airport_cd"]
MAP_MEASURES = {
    "gender": ("gender", "string"),
    "trip_purpose": ("trip_purpose", "string"),
    "visa_type": ("visa_type", "string"),
    "countries": ("country_id", "int"),
    "airlines": ("airline_cd", "string"),
}
FACT_COLUMNS = ["month", "airport_cd", "gender", "avg_stay", "median_age",
                "trip_purpose", "visa_type", "countries", "airlines"]

# Race labels of the city file and their output column names.
RACE_COLUMNS = {
    "American Indian and Alaska Native": "native_am_pop",
    "Asian": "asian_pop",
    "Black or African-American": "black_pop",
    "Hispanic or Latino": "hispanic_pop",
    "White": "white_pop",
}
# The temperature file's country label and first year kept.
US_COUNTRY = "United States"
MIN_TEMPERATURE_YEAR = 1950


def clean_arrivals(raw: DataFrame) -> DataFrame:
    """Air arrivals at real ports, typed, deduplicated, then decoded.

    The dedup runs on the ten typed attributes *before* codes are mapped
    (so code 4 and NULL purpose stay two rows, and so do gender ``X`` and
    NULL).  There is no person id: equal profiles collapse into one row.
    Accepts numeric (binary files) or text (CSV) raw columns.
    """
    typed = (
        raw.filter((X.to_double("i94mode") == F.lit(float(X.AIR_MODE)))
                   & ~F.col("i94port").isin(*X.INVALID_PORTS))
        .select(
            X.to_int("i94mon").alias("month"),
            X.to_int("i94cit").alias("country_id"),
            F.col("i94port").cast("string").alias("airport_cd"),
            X.to_int("arrdate").alias("arrival_date"),
            X.to_int("depdate").alias("departure_date"),
            X.to_int("i94bir").alias("age"),
            X.to_int("i94visa").alias("trip_purpose"),
            F.col("gender").cast("string").alias("gender"),
            F.col("airline").cast("string").alias("airline_cd"),
            F.col("visatype").cast("string").alias("visa_type"),
        )
        .dropDuplicates()
    )
    arrival = X.sas_to_date("arrival_date")
    departure = X.sas_to_date("departure_date")
    return typed.select(
        "month", "country_id", "airport_cd", "age",
        X.trip_purpose("trip_purpose").alias("trip_purpose"),
        X.null_if("gender", X.GENDER_UNKNOWN).alias("gender"),
        "airline_cd", "visa_type",
        X.days_between(departure, arrival).alias("length_of_stay"),
    )


def fact_measures(measures: Sequence[str] | None = None, *, empty_median: str = "nan", with_visits: bool = False,
                  count_type: str = "int") -> Measures:
    """What the fact's measure columns are computed from (default: all of them)."""
    wanted = FACT_COLUMNS[len(FACT_KEYS):] if measures is None else list(measures)
    unknown = set(wanted) - set(FACT_COLUMNS[len(FACT_KEYS):])
    if unknown:
        raise ValueError(f"no such measures: {sorted(unknown)}")
    return Measures(
        count_maps={m: spec for m, spec in MAP_MEASURES.items() if m in wanted},
        means={"avg_stay": "length_of_stay"} if "avg_stay" in wanted else {},
        medians={"median_age": "age"} if "median_age" in wanted else {},
        row_count_col="visits" if with_visits else None,
        empty_median=empty_median,
        count_type=count_type,
    )


def build_immigration(clean: DataFrame, *, empty_median: str = "nan", stable_id: bool = False,
                      with_visits: bool = False, count_type: str = "int",
                      measures: Sequence[str] | None = None) -> DataFrame:
    """M1: the fact table, one row per (month, airport_cd).

    Measures: five value->count maps, ``round(avg(length_of_stay), 2)`` and
    the exact median age, all from one lineage (see ``grouped_measures``).
    A NULL month forms its own group with its measures filled (the original's
    equality joins left them NULL).  ``with_visits`` adds the row count the
    original computed but did not store.  Map counts are ``int`` as in the
    output contract; a count beyond 2^31 raises (ANSI) rather than wrapping,
    and ``count_type='bigint'`` widens the maps for inputs that large.

    ``measures``: the measure columns to build (default: all).  Entries are made
    for these alone, since Spark can't prune unused ones out of the unpivot;
    without any map the mean and the median are plain aggregates, and with none
    at all the fact is the distinct keys and their ids.
    """
    spec = fact_measures(measures, empty_median=empty_median, with_visits=with_visits, count_type=count_type)
    if spec.count_maps:
        built = spec.from_counts(spec.counts(clean, FACT_KEYS), FACT_KEYS)
    elif spec.means or spec.medians or with_visits:
        # no map, no unpivot: one aggregate, and its shuffle is the only one above the dedup's
        plain = [row_count().alias("visits")] if with_visits else []
        plain += [rounded_mean(src, spec.digits).alias(out) for out, src in spec.means.items()]
        plain += [exact_median(X.to_double(src), empty_median).alias(out) for out, src in spec.medians.items()]
        built = clean.groupBy(*FACT_KEYS).agg(*plain)
    else:
        built = clean.select(*FACT_KEYS).distinct()
    return finish_fact(built, stable_id)


def finish_fact(built: DataFrame, stable_id: bool = False) -> DataFrame:
    """The built measures in the fact's column order, with an id."""
    cols = [c for c in (*FACT_COLUMNS, "visits") if c in built.columns]
    id_col = X.surrogate_id(*FACT_KEYS) if stable_id else X.surrogate_id()
    return built.select(*cols, id_col.alias("immigration_id"))


def build_airports(raw: DataFrame, *, require_iata: bool = False, require_city: bool = False,
                   country: str = "US") -> DataFrame:
    """M2: US airports (type contains 'airport'), state from ``iso_region``,
    latitude/longitude from ``coordinates`` ("lon, lat"), deduplicated per row.

    A code may still repeat when two rows differ (checked by Q2); set
    ``require_iata`` / ``require_city`` to drop rows without code or city.
    """
    df = raw.filter(F.col("iso_country") == country).filter(F.col("type").like("%airport%"))
    if require_iata:
        df = df.filter(F.col("iata_code").isNotNull())
    if require_city:
        df = df.filter(F.col("municipality").isNotNull())
    return df.select(
        F.col("iata_code").alias("airport_cd"),
        F.col("type"),
        F.col("name"),
        X.split_get("iso_region", "-", 1).alias("state"),
        F.col("municipality").alias("city"),
        X.to_double(X.split_get("coordinates", ",", 1)).alias("latitude"),
        X.to_double(X.split_get("coordinates", ",", 0)).alias("longitude"),
    ).dropDuplicates()


def build_demographics(raw: DataFrame) -> DataFrame:
    """M3: city attributes (deduplicated) beside the race counts as five columns, by (city, state).

    One aggregate reads the file once: a city's distinct attribute rows as a
    set, its counts as conditional sums.  A city has one attribute row in
    practice; the set is bounded by its distinct ones, not by its rows.  Rows
    with a NULL city or state drop out, as in the original inner join.
    """
    attributes = F.struct(
        X.to_double("Median Age").alias("median_age"),
        X.to_int("Male Population").alias("male_pop"),
        X.to_int("Female Population").alias("female_pop"),
        X.to_int("Total Population").alias("total_pop"),
        X.to_int("Number of Veterans").alias("veterans"),
        X.to_int("Foreign-born").alias("foreign_born"),
        X.to_double("Average Household Size").alias("avg_hh_size"),
    )
    count = X.to_double("Count")
    sums = [F.sum(F.when(F.col("Race") == race, count)).alias(out) for race, out in RACE_COLUMNS.items()]
    cities = (
        raw.where(F.col("City").isNotNull() & F.col("State Code").isNotNull())
        .groupBy(F.col("City").alias("city"), F.col("State Code").alias("state"))
        .agg(F.collect_set(attributes).alias("rows"), *sums)
    )
    return cities.select("city", "state", F.explode("rows").alias("a"), *RACE_COLUMNS.values()).select(
        "city", "state", "a.median_age", "a.male_pop", "a.female_pop",
        # a population beyond 32 bits raises instead of turning into NULL
        *[F.col(c).cast("int").alias(c) for c in RACE_COLUMNS.values()],
        "a.veterans", "a.foreign_born", "a.avg_hh_size",
    )


def build_temperature(raw: DataFrame, *, min_year: int = MIN_TEMPERATURE_YEAR,
                      country: str = US_COUNTRY, empty_median: str = "nan", hot_rows: int | None = None) -> DataFrame:
    """M4: monthly median of the average temperature (Fahrenheit, 2 decimals)
    per city and coordinates, from ``min_year`` on.

    The dedup runs after the year is dropped, so the median is over the
    *distinct* rounded temperatures of a (month, city, lat, long) group; it is
    fused with the median into one aggregation (one shuffle).

    Rounded temperatures are few, so a group's set of them is small.  ``hot_rows``: for readings of any
    precision, groups of more distinct values than that are
    selected from step by step (``selected_median``) instead of held as a set.
    """
    dated = (
        raw.filter(F.col("Country") == country)
        .withColumn("dim_date", X.parse_date("dt"))
        .filter(F.year("dim_date") >= min_year)
        .na.drop(subset=["AverageTemperature"])
    )
    rows = dated.select(
        F.month("dim_date").alias("month"),
        X.round_half_up(X.celsius_to_fahrenheit(X.to_double("AverageTemperature")), 2).alias("avg_temp"),
        F.col("City").alias("city"),
        X.signed_coordinate("Latitude").alias("latitude"),
        X.signed_coordinate("Longitude").alias("longitude"),
    )
    keys = ["month", "city", "latitude", "longitude"]
    if hot_rows is not None:
        return selected_median(rows.distinct(), keys, "avg_temp", "median_avg_temp", empty_median, hot_rows)
    # dedup + median fused: the group keys are part of the dedup key, so the
    # median over distinct rows is the median of the group's distinct values
    return (rows.groupBy(*keys)
            .agg(distinct_median("avg_temp", empty_median).alias("median_avg_temp")))
