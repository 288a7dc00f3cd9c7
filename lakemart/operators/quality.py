"""Data-quality checks (Q1-Q8).

Every check returns a small DataFrame and triggers no job by itself; the
caller decides when to run it (``first()``, ``toPandas()``, a sink).  Each is
one scan plus at most one shuffle of already partially aggregated rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.columns import map_codes
from lakemart.operators.aggregates import null_count


def _long_form(wide: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    return wide.unpivot([], list(columns), name, value)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None, long: bool = True) -> DataFrame:
    """Q1: NULL count of every column in one pass.

    ``long=True`` gives rows ``(column_name, null_count)``; ``long=False`` one
    wide row with a count per column.
    """
    cols = list(columns) if columns else df.columns
    wide = df.agg(*[null_count(F.col(f"`{c}`")).alias(c) for c in cols])
    return _long_form(wide, cols, "column_name", "null_count") if long else wide


def duplicate_keys(df: DataFrame, keys: Sequence[str], min_count: int = 2) -> DataFrame:
    """Q2: number of key values that occur at least ``min_count`` times."""
    per_key = df.groupBy(*keys).count()
    return (per_key.filter(F.col("count") >= min_count)
            .agg(F.count(F.lit(1)).alias("duplicate_keys")))


def distinct_count(df: DataFrame, columns: Sequence[str], expected: int | None = None) -> DataFrame:
    """Q3: number of distinct values (NULL counts as a value, like ``distinct().count()``).

    With ``expected`` a boolean ``as_expected`` column is added.
    """
    out = df.select(*columns).distinct().agg(F.count(F.lit(1)).alias("distinct_count"))
    if expected is not None:
        out = out.withColumn("as_expected", F.col("distinct_count") == F.lit(expected))
    return out


def join_coverage(fact: DataFrame, dim: DataFrame, key: str, fact_cols: Sequence[str]) -> DataFrame:
    """Q4: distinct ``fact_cols`` of fact rows that find a match in ``dim``.

    Same number as ``fact.join(dim, key).select(fact_cols).distinct().count()``
    but as a semi join, so a key repeated in the dimension does not multiply
    fact rows before the distinct.
    """
    matched = fact.join(dim.select(key), on=key, how="left_semi")
    return matched.select(*fact_cols).distinct().agg(F.count(F.lit(1)).alias("matched"))


def has_type(df: DataFrame, column: str, data_type: T.DataType) -> bool:
    """Q5: column type check (schema only, no job)."""
    return df.schema[column].dataType == data_type


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Q6: ``(column_name, data_type, non_null)`` for every column, one pass."""
    cols = list(columns) if columns else df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wide = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in cols])
    return (_long_form(wide, cols, "column_name", "non_null")
            .withColumn("data_type", map_codes("column_name", {c: types[c] for c in cols}))
            .select("column_name", "data_type", "non_null"))


def max_value(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """Global maximum (partial max per task, one tiny shuffle)."""
    return df.agg(F.max(column).alias(alias or f"max_{column}"))


def categories(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column."""
    return df.select(column).distinct()


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows (a sample preview is the feature here)."""
    return df.limit(n)
