"""Join operators.

No join hint is given: the dimension tables here grow with the data, so the
strategy is left to Spark (a broadcast only when the runtime size is under
``spark.sql.autoBroadcastJoinThreshold``, else a shuffle join, with AQE skew
splitting).  Joins on grouped tables reuse the grouping's hash partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str],
                 how: str = "inner", null_safe: bool = False) -> DataFrame:
    """Equi-join on same-named key columns, keeping one copy of each key.

    ``null_safe=True`` matches NULL keys to NULL keys (``<=>``).
    """
    keys = list(keys)
    if not null_safe:
        return left.join(right, on=keys, how=how)
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    joined = left.join(renamed, on=cond, how=how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return joined
    if how in ("inner", "left", "left_outer", "leftouter"):
        return joined.drop(*[f"__r_{k}" for k in keys])
    coalesced = [F.coalesce(F.col(k), F.col(f"__r_{k}")).alias(k) for k in keys]
    rest = [c for c in joined.columns if c not in keys and not c.startswith("__r_")]
    return joined.select(*coalesced, *rest)


def join_measures(base: DataFrame, frames: Sequence[DataFrame], keys: Sequence[str],
                  how: str = "left", null_safe: bool = True) -> DataFrame:
    """Left-join several per-key measure frames onto a base frame.

    Null-safe by default, so a NULL key keeps its measures (the original's
    plain equality lost them).
    """
    return reduce(lambda acc, fr: join_on_keys(acc, fr, keys, how, null_safe), frames, base)


def unique_by(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row with the smallest ``order_cols`` (default: all columns).

    Uses ``min_by`` over a struct inside an aggregate (partial aggregation,
    no sort of a whole group), so a hot key does not land in one task.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    order = list(order_cols) if order_cols else others
    row = F.struct(*[F.col(c) for c in others])
    order_key = F.struct(*[F.col(c) for c in order])
    picked = df.groupBy(*keys).agg(F.min_by(row, order_key).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in others])


def snowflake(fact: DataFrame, airports: DataFrame, demographics: DataFrame,
              temperature: DataFrame, fact_cols: Sequence[str] | None = None, by_place: bool = False) -> DataFrame:
    """Fact -> airport -> demographics (city, state) and temperature (city, month).

    The airport dimension is first made unique per code, so the fact grain
    (month, airport_cd) is kept through the airport join.  Temperature is
    keyed by city alone in the model, so equal city names in different states
    can repeat a fact row.  ``by_place`` tells them apart by their coordinates: a
    fact row gets the temperature of the city of that name that is nearest
    to its airport, one row for each month.
    """
    cols = list(fact_cols) if fact_cols else [
        c for c in fact.columns if c not in ("gender", "trip_purpose", "visa_type", "countries", "airlines")
    ]
    airport_dim = unique_by(airports.filter(F.col("airport_cd").isNotNull()), ["airport_cd"])
    airport_dim = airport_dim.select(
        "airport_cd", F.col("city"), F.col("state"),
        F.col("name").alias("airport_name"), F.col("type").alias("airport_type"),
        *([F.col("latitude").alias("__lat"), F.col("longitude").alias("__lon")] if by_place else []))
    demo = demographics.drop("median_age").withColumnRenamed("avg_hh_size", "avg_household_size")
    temp = temperature.select("month", "city", "median_avg_temp")
    joined = (
        fact.select(*cols)
        .join(airport_dim, on="airport_cd", how="inner")
        .join(demo, on=["city", "state"], how="left")
    )
    if not by_place:
        return joined.join(temp, on=["city", "month"], how="left")
    from lakemart.operators.nearest import nearest_locations

    place = nearest_locations(airport_dim, temperature, ["city"], ("__lat", "__lon")).select(
        "city", F.col("lat").alias("__lat"), F.col("lon").alias("__lon"),
        F.col("to_lat").alias("__to_lat"), F.col("to_lon").alias("__to_lon"))
    temp = temperature.select("month", "city", F.col("latitude").alias("__to_lat"), F.col("longitude").alias("__to_lon"), "median_avg_temp")
    joined = join_on_keys(joined, place, ["city", "__lat", "__lon"], how="left", null_safe=True)
    return (joined.join(temp, on=["city", "month", "__to_lat", "__to_lon"], how="left")
            .drop("__lat", "__lon", "__to_lat", "__to_lon"))
