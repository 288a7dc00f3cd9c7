"""Nearest location by coordinates (J4, equal names told apart by place).

Locations are dealt into cells of a grid.  A location is compared with those
of its own and the eight neighbouring cells; the nearest found is the nearest
of all if it lies within one cell's width.  What is left goes on to a grid of
twice the width, up to one cell for the whole globe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.operators.joins import join_on_keys
from lakemart.session import stored

#: Cells around the globe at first; a power of two.
CELLS = 512


def _cell(lat: Column, lon: Column, cells: int) -> tuple[Column, Column]:
    width = 360.0 / cells
    return F.floor(lat / width), F.least(F.floor(F.pmod(lon + 180.0, F.lit(360.0)) / width), F.lit(cells - 1))


def _squared(lat: Column, lon: Column, to_lat: Column, to_lon: Column) -> Column:
    """Squared distance in degrees; longitudes meet at 180."""
    north, east = lat - to_lat, F.pmod(F.abs(lon - to_lon), F.lit(360.0))
    east = F.least(east, 360.0 - east)
    return north * north + east * east


def nearest_locations(left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: tuple[str, str] = ("latitude", "longitude"),
                      right_at: tuple[str, str] = ("latitude", "longitude"), cells: int = CELLS) -> DataFrame:
    """(keys, lat, lon, to_lat, to_lon): for each location of ``left`` the nearest one of ``right`` with equal keys.

    Distances are plain degrees, longitudes meet at 180; of equally near ones
    the one with the lesser (latitude, longitude).  Locations without a
    coordinate get the keys' location if there is only one, else none.  NULL
    keys match none, and neither do keys that ``right`` doesn't have.  Each
    distinct location is compared once, however many rows stand at it; empty tables give
    no rows.
    """
    keys = list(keys)

    def located(df: DataFrame, at: tuple[str, str], lat: str, lon: str) -> DataFrame:
        return (df.select(*keys, F.col(at[0]).cast("double").alias(lat), F.col(at[1]).cast("double").alias(lon))
                .na.drop(subset=keys).distinct())

    there = stored(located(right, right_at, "to_lat", "to_lon").na.drop(), "locations")
    here = located(left, left_at, "lat", "lon")
    here = stored(here.join(there.select(*keys).distinct(), keys, "left_semi"), "locations")
    unplaced = here.where("lat IS NULL OR lon IS NULL")
    only = there.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("to_lat").alias("to_lat"), F.min("to_lon").alias("to_lon"))
    out = unplaced.join(only.where("n = 1").drop("n"), keys)
    open_ = here.where("lat IS NOT NULL AND lon IS NOT NULL")
    while True:
        y, x = _cell(F.col("lat"), F.col("lon"), cells)
        step = F.array(*[F.lit(i) for i in (-1, 0, 1)])
        around = (open_.withColumn("y", F.explode(F.transform(step, lambda i: y + i)))
                  .withColumn("x", F.explode(F.array_distinct(F.transform(step, lambda i: F.pmod(x + i, F.lit(cells)))))))
        to_y, to_x = _cell(F.col("to_lat"), F.col("to_lon"), cells)
        dealt = there.withColumn("y", to_y).withColumn("x", to_x)
        near = F.struct(_squared(F.col("lat"), F.col("lon"), F.col("to_lat"), F.col("to_lon")).alias("d"), "to_lat", "to_lon")
        best = around.join(dealt, [*keys, "y", "x"]).groupBy(*keys, "lat", "lon").agg(F.min(near).alias("b"))
        if cells > 1:
            best = best.where(F.col("b.d") <= (360.0 / cells) ** 2)
        best = stored(best.select(*keys, "lat", "lon", "b.to_lat", "b.to_lon"), "nearest")
        out = out.unionByName(best)
        open_ = join_on_keys(open_, best.select(*keys, "lat", "lon"), [*keys, "lat", "lon"], "left_anti")
        # the last grid: latitudes beyond its cells' reach don't occur, 360 degrees span the globe
        if cells == 1 or open_.isEmpty():
            return out
        cells = max(1, cells // 4)
