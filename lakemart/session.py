"""Session helpers.

The library never builds its own session inside a builder: every function
takes the caller's ``SparkSession``.  ``get_session`` is a convenience for
tests, the bench and command-line runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "lakemart") -> SparkSession:
    """Return (or create) a session tuned for the builders.

    On a cluster ``master`` is left to ``spark-submit``.  Locally the number of
    shuffle partitions follows the core count; on a cluster AQE coalesces the
    configured number down to what the data needs at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # no Python call-site capture per Column call (4 JVM round trips each);
        # it only adds the user's line number to error messages
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        # partition values are read back with explicit schemas, never inferred
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    )
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", os.environ.get("LAKEMART_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    ckpt = spark.sparkContext.getCheckpointDir()
    if ckpt:
        return ckpt
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    return spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, unique folder under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session.  Only when it is unset
    on a ``local`` master (tests) is a folder under the local temp dir chosen
    and registered; on a cluster an unset value is an error, so executors
    always write to shared storage.
    """
    base = _configured_checkpoint_dir(spark)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: on a cluster scratch data must go to the "
                "shared folder named there, never to an executor-local temp folder")
        base = tempfile.mkdtemp(prefix="lakemart-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        base = _configured_checkpoint_dir(spark) or base
    return f"{base.rstrip('/')}/lakemart-{name}-{uuid.uuid4().hex}"


def stored_at(df: DataFrame, name: str = "step") -> tuple[str, DataFrame]:
    """``df`` written to a new folder of the shared scratch folder and read back: (folder, rows).

    Its lineage is cut, so a lost executor costs no recomputation of it, and
    its size is known to the planner.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return path, spark.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """The rows of ``stored_at``."""
    return stored_at(df, name)[1]


def removed(spark: SparkSession, path: str) -> None:
    """Remove a folder made by ``stored_at`` whose rows nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
