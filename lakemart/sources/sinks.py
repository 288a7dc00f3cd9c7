"""Sinks (K1-K4) and schema-explicit read-back.

Writes go through Spark's file commit protocol, so a lost executor only
re-runs its tasks; nothing is half-written at the target.  Before a
partitioned write the rows are *rebalanced* on the partition columns: AQE
then splits a skewed partition value over several tasks and merges small
ones, which avoids both the many-small-files problem and a single task
writing a hot month.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.sources.schemas import OUTPUT_TABLES, immigration_schema


def default_writers(spark: SparkSession) -> int:
    """Writing tasks if none are stated: the shuffle partitions of the session.

    Not the cores seen by the driver: with dynamic allocation these are the few
    that have registered so far.
    """
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
    mode: str = "errorifexists",
    fmt: str = "parquet",
    rebalance: bool = True,
    options: dict[str, str] | None = None,
    writers: int | None = None,
    metrics: Mapping[str, Column] | None = None,
) -> dict[str, object]:
    """Write ``df`` to ``path``; default mode fails if the path exists.

    ``writers``: for *aggregated* tables with a bounded number of rows per
    partition value (the four output tables), spread the partition folders
    over this many tasks (``repartition(writers, xxhash64(*partition_by))``;
    AQE keeps a user-given count).  Byte-based rebalancing would put a small table with
    thousands of partition values into one task that then creates every
    file in sequence.  Leave it ``None`` for row-level data, where the
    rebalance hint splits hot partition values by size.

    ``metrics``: aggregates over the rows as they are written, returned by
    name; they cost no scan of their own (``Observation``).
    """
    parts = list(partition_by or [])
    if writers and parts:
        # hash of the partition columns, not the columns themselves: an
        # aggregate below is already partitioned by them, and the planner would
        # drop the user count and let AQE coalesce everything into one task
        df = df.repartition(writers, F.xxhash64(*parts))
    elif rebalance:
        df = df.hint("rebalance", *parts) if parts else df.hint("rebalance")
    seen = Observation()
    if metrics:
        df = df.observe(seen, *[c.alias(name) for name, c in metrics.items()])
    writer = df.write.mode(mode).format(fmt)
    if parts:
        writer = writer.partitionBy(*parts)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save(path)
    return seen.get if metrics else {}


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` bucketed by ``keys`` and read it as a table: joins and groupings by the keys need no shuffle.

    One shuffle here, by the function that buckets use, so a bucket is one
    file.  The session's catalog has the table under a name of its own; the data
    lie at ``path``.
    """
    name = f"lakemart_{uuid.uuid4().hex}"
    (df.repartition(buckets, *keys).write.format(fmt).option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return df.sparkSession.table(name)


@contextmanager
def _few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Within the block Spark lists folders by ``default_writers`` tasks at most, restored after.

    By default each folder (up to 10,000) gets a task, whose start costs far more than
    listing the one or few files of a partition folder.
    """
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), default_writers(spark))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read_back(spark: SparkSession, path: str, schema: T.StructType,
              partition_by: Sequence[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """Read a stored table with its explicit schema, columns in schema order.

    Partition columns are typed by ``schema``, not inferred from the folder
    names (a folder set whose only ``airport_cd`` is ``007`` would otherwise
    come back as an int).  Filters on partition columns prune folders.  An empty
    table gives no rows, and hidden folders (a refresh's staging data) are not read.
    The folders are all listed here, each task taking many of them.
    """
    with _few_listing_tasks(spark):
        df = spark.read.format(fmt).schema(schema).load(path)
    return df.select(*[f.name for f in schema.fields])


def read_output(spark: SparkSession, base: str, table: str, count_type: str = "int") -> DataFrame:
    """Read one of the four output tables back under ``base/table``.

    ``count_type`` must match the fact's build (``'bigint'`` after wide counts).
    """
    schema, parts = OUTPUT_TABLES[table]
    if table == "immigration":
        schema = immigration_schema(count_type)
    return read_back(spark, f"{base.rstrip('/')}/{table}", schema, parts)
