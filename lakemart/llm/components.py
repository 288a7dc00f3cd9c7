"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a grouped minimum (combined before its shuffle) and one join
back, so a hub with a large share of all edges costs a split join, never a
group in one task.  Each round is written to the shared scratch folder, which
cuts the lineage and survives a lost executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart import session
from lakemart.session import removed


def stored_at(df: DataFrame, spark: SparkSession, name: str) -> tuple[str, DataFrame]:
    """Write to a new folder of the shared scratch folder and read back: (folder, rows)."""
    return session.stored_at(df, name)


def stored(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back."""
    return session.stored(df, name)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over rows (u, v), u > v: nodes hang on the least neighbour."""
    if large:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        hung = edges.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = hung.unionAll(low.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def connected_components(edges: DataFrame, spark: SparkSession) -> DataFrame:
    """(node, component) for every node of the edges (a, b); component: its least node.

    Self-edges and repeated edges do no harm; edges with a null end are left
    out; no edges give no rows.
    """
    path, cur = stored_at(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                          .where("a IS NOT NULL AND b IS NOT NULL AND u > v").distinct(), spark, "cc")
    before = None
    while True:
        now = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == before or not now[0]:
            break
        before = now
        old = path
        path, cur = stored_at(_star(_star(cur, True), False), spark, "cc")
        removed(spark, old)
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionAll(cur.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
