"""Aggregate operators.

Single measures are plain ``pyspark.sql.functions`` aggregates.  The one
composite is :func:`grouped_measures`: it computes row counts, rounded means,
exact medians and value->count maps for many columns in **one** lineage with
two small aggregations, instead of one aggregate per measure joined back
together (the original's eight aggregates and seven joins).

Scale notes
-----------
* Every aggregate here has a partial (map-side) phase, so a hot group (one
  key holding a third of all rows) is reduced inside each map task before the
  shuffle.  No operator collects the raw rows of a group.
* Per-group state after the first level is bounded by the number of
  *distinct* values of a measure in that group (ages, codes, countries), not
  by the number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import ColumnOrName, _col, to_double

_ROWS = "__rows"


# --- Column-level aggregate expressions ------------------------------------------

def row_count() -> Column:
    """A1: rows per group."""
    return F.count(F.lit(1))


def rounded_mean(c: ColumnOrName, digits: int = 2) -> Column:
    """A2: ``round(avg(c), digits)``; NULLs ignored, all-NULL -> NULL."""
    return F.round(F.avg(_col(c)), digits)


def exact_median(c: ColumnOrName, empty: str = "nan") -> Column:
    """A3: exact median (even count -> mean of the two middle values).

    ``empty='nan'`` returns NaN for a group without values (the original's
    behaviour); ``empty='null'`` returns NULL.
    """
    med = F.median(_col(c))
    return _empty_median(med, empty)


def distinct_median(c: ColumnOrName, empty: str = "nan") -> Column:
    """Exact median of the *distinct* non-NULL values of ``c`` in a group.

    Equal to ``dropDuplicates`` on (keys, c) followed by a median, in one
    aggregation: ``collect_set`` drops duplicates map-side, so the state is
    bounded by the distinct values of the group, and the sorted set is
    indexed at its middle.  ``0.5*lo + 0.5*hi`` is bit-equal to Spark's
    ``percentile`` interpolation.
    """
    # + 0.0 folds -0.0 into 0.0, as grouping keys are normalised
    vals = F.array_sort(F.collect_set(_col(c) + F.lit(0.0)))
    n = F.size(vals)
    lo = F.get(vals, F.floor((n - 1) / 2).cast("int"))
    hi = F.get(vals, F.floor(n / 2).cast("int"))
    return _empty_median(lo * F.lit(0.5) + hi * F.lit(0.5), empty)


def _empty_median(med: Column, empty: str) -> Column:
    if empty == "nan":
        return F.coalesce(med, F.lit(float("nan")))
    if empty == "null":
        return med
    raise ValueError(f"empty must be 'nan' or 'null', not {empty!r}")


def null_count(c: ColumnOrName) -> Column:
    """Number of rows where ``c`` is NULL."""
    return F.count_if(_col(c).isNull())


# --- fused per-group measures (A1-A5) -------------------------------------------------

@dataclass(frozen=True)
class Measures:
    """What ``grouped_measures`` computes for each group.

    ``count_maps``: ``{out: (column, 'string'|'int')}`` -> ``map<key, count>``
    of the non-NULL values (an all-NULL group gives an empty map).
    ``means``: ``{out: column}`` -> ``round(avg, digits)``.
    ``medians``: ``{out: column}`` -> exact median.
    ``row_count_col``: name of an optional row-count column (bigint).
    """

    count_maps: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    means: Mapping[str, str] = field(default_factory=dict)
    medians: Mapping[str, str] = field(default_factory=dict)
    row_count_col: str | None = None
    digits: int = 2
    empty_median: str = "nan"
    count_type: str = "int"

    def __post_init__(self):
        names = [_ROWS, *self.count_maps, *self.means, *self.medians]
        if len(set(names)) != len(names):
            raise ValueError(f"output names must be distinct: {names}")
        for _, key_type in self.count_maps.values():
            if key_type not in ("string", "int"):
                raise ValueError(f"key type must be 'string' or 'int', not {key_type!r}")

    @property
    def tags(self) -> dict[str, int]:
        """Measures by a small integer (cheaper to shuffle and hash than a name)."""
        return {name: i for i, name in enumerate([_ROWS, *self.count_maps, *self.means, *self.medians])}

    def counts(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """(keys, m, s, i, d, n, sv): how often each value of each measure stands in each group.

        m is the measure's tag; s, i or d is the value (counted per distinct
        value); sv sums the values of means, which collapse to one row per
        group like avg's buffer.  Counts of several inputs merge: add up n and sv by the
        other columns (``merge_counts``).
        """
        tag = self.tags
        tag_type = "tinyint" if len(tag) < 128 else "int"
        null_s, null_i, null_d = (F.lit(None).cast(t) for t in ("string", "bigint", "double"))

        def entry(name: str, s: Column = null_s, i: Column = null_i, d: Column = null_d, v: Column = null_d) -> Column:
            return F.struct(F.lit(tag[name]).cast(tag_type).alias("m"),
                            s.alias("s"), i.alias("i"), d.alias("d"), v.alias("v"))

        entries = [entry(_ROWS)]
        for out, (src, key_type) in self.count_maps.items():
            value = _col(src)
            entries.append(entry(out, s=value.cast("string")) if key_type == "string" else entry(out, i=value.cast("bigint")))
        entries += [entry(out, v=to_double(src)) for out, src in self.means.items()]
        entries += [entry(out, d=to_double(src)) for out, src in self.medians.items()]
        long = (
            df.select(*keys, F.inline(F.array(*entries)))
            .filter((F.col("m") == tag[_ROWS]) | F.col("s").isNotNull() | F.col("i").isNotNull()
                    | F.col("d").isNotNull() | F.col("v").isNotNull())
        )
        return long.groupBy(*keys, "m", "s", "i", "d").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("sv"))

    def from_counts(self, counted: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The measures of each group, from merged counts."""
        tag = self.tags
        m, s, i, d, n, sv = (F.col(x) for x in ("m", "s", "i", "d", "n", "sv"))
        n_out = n.cast(self.count_type)
        aggs: list[Column] = []
        if self.row_count_col:
            aggs.append(F.sum(F.when(m == tag[_ROWS], n)).alias(self.row_count_col))
        for out, (_, key_type) in self.count_maps.items():
            key = s if key_type == "string" else i.cast("int")
            pairs = F.collect_list(F.when(m == tag[out], F.struct(key.alias("key"), n_out.alias("value"))))
            aggs.append(F.map_from_entries(F.array_sort(pairs)).alias(out))
        for out in self.means:
            total = F.sum(F.when(m == tag[out], sv))
            weight = F.sum(F.when(m == tag[out], n))
            aggs.append(F.round(total / weight, self.digits).alias(out))
        for out in self.medians:
            med = F.percentile(F.when(m == tag[out], d), F.lit(0.5), n)
            aggs.append(_empty_median(med, self.empty_median).alias(out))
        return counted.groupBy(*keys).agg(*aggs)


def merge_counts(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per (keys, m, s, i, d) from the rows of several ``Measures.counts``."""
    return counted.groupBy(*keys, "m", "s", "i", "d").agg(F.sum("n").alias("n"), F.sum("sv").alias("sv"))


def grouped_measures(
    df: DataFrame,
    keys: Sequence[str],
    *,
    count_maps: Mapping[str, tuple[str, str]] | None = None,
    means: Mapping[str, str] | None = None,
    medians: Mapping[str, str] | None = None,
    row_count_col: str | None = None,
    digits: int = 2,
    empty_median: str = "nan",
    count_type: str = "int",
) -> DataFrame:
    """Per-group measures over ``df`` in one pass (see ``Measures`` for the arguments).

    Plan: each row is unpivoted into one entry per measure (NULL values
    dropped).  Entries are counted per ``(keys, measure, value)`` with
    map-side combine (mean inputs are only summed, so a mean is one partial
    sum and count per group), and a second aggregation per ``keys`` turns
    them into maps, means and weighted exact medians
    (``percentile(value, 0.5, count)``).  Every group of ``df`` appears once,
    even if all its measures are NULL.
    """
    measures = Measures(dict(count_maps or {}), dict(means or {}), dict(medians or {}), row_count_col, digits,
                        empty_median, count_type)
    return measures.from_counts(measures.counts(df, list(keys)), list(keys))


def count_map(df: DataFrame, keys: Sequence[str], column: str, key_type: str = "string",
              out: str | None = None, count_type: str = "int") -> DataFrame:
    """A4 for one column: keys + ``map<value, count>`` (empty map if all NULL).

    The values are counted as they are (map-side combine), without the unpivot
    that several measures of ``grouped_measures`` share.
    """
    if key_type not in ("string", "int"):
        raise ValueError(f"key type must be 'string' or 'int', not {key_type!r}")
    key = F.col("__key")
    counted = (df.select(*keys, _col(column).cast(key_type).alias("__key"))
               .groupBy(*keys, "__key").agg(F.count(F.lit(1)).cast(count_type).alias("__n")))
    pairs = F.collect_list(F.when(key.isNotNull(), F.struct(key.alias("key"), F.col("__n").alias("value"))))
    return counted.groupBy(*keys).agg(F.map_from_entries(F.array_sort(pairs)).alias(out or column))


def explode_map(df: DataFrame, keys: Sequence[str], map_col: str,
                key_name: str = "key", value_name: str = "n") -> DataFrame:
    """Long form of a map column: one row per (keys, key, count)."""
    return (df.select(*keys, F.explode(F.col(map_col)).alias(key_name, value_name)))


def lower_median(df: DataFrame, keys: Sequence[str], column: str, out: str | None = None) -> DataFrame:
    """A3, scale option: keys + the exact lower median of ``column`` (``percentile_disc(0.5)``).

    An actual input value in the column's own type: the middle one, for an
    even count the lower of the two; NULLs ignored, all-NULL -> NULL.  Values
    are counted first (map-side combine), so a hot group is spread over the
    tasks and its state is bounded by its distinct values, whatever its rows.
    """
    value = F.col("__value")
    counted = (df.select(*keys, _col(column).alias("__value"))
               .groupBy(*keys, "__value").agg(F.count(F.lit(1)).alias("__n")))
    pairs = F.collect_list(F.when(value.isNotNull(), F.struct(value.alias("value"), F.col("__n").alias("n"))))
    grouped = counted.groupBy(*keys).agg(
        F.array_sort(pairs).alias("__pairs"), F.sum(F.when(value.isNotNull(), F.col("__n"))).alias("__total"))
    nothing = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast(counted.schema["__value"].dataType).alias("value"))

    def step(acc: Column, pair: Column) -> Column:
        seen = acc["seen"] + pair["n"]
        here = (acc["seen"] * 2 < F.col("__total")) & (seen * 2 >= F.col("__total"))
        return F.struct(seen.alias("seen"), F.when(here, pair["value"]).otherwise(acc["value"]).alias("value"))

    return grouped.select(*keys, F.aggregate("__pairs", nothing, step, lambda acc: acc["value"]).alias(out or column))


# --- pivot (A6, A11, A12, C1, C2) ----------------------------------------------------------

def pivot_agg(
    df: DataFrame,
    keys: Sequence[str],
    pivot_col: str,
    values: Sequence[Any],
    agg: Column | Mapping[str, str],
    renames: Mapping[str, str] | None = None,
    fill: Any = None,
) -> DataFrame:
    """``groupBy(keys).pivot(pivot_col, values).agg(agg)`` with optional renames.

    Passing the value list avoids the extra job that discovers distinct pivot
    values and makes a value absent from the data a NULL column rather than a
    missing one.  ``agg`` may be a Column or a dict spec (``{'col': 'sum'}``).
    """
    grouped = df.groupBy(*keys).pivot(pivot_col, list(values))
    # with a single aggregate each output column is named after its pivot value
    out = grouped.agg(dict(agg)) if isinstance(agg, Mapping) else grouped.agg(agg)
    if fill is not None:
        out = out.na.fill(fill, subset=[str(v) for v in values])
    if renames:
        out = out.withColumnsRenamed(dict(renames))
    return out


def pivot_sum(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence[Any],
              value_col: str, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Sum of a (possibly text) column per pivot value, typed by ``try_cast``."""
    typed = df.withColumn(value_col, to_double(value_col))
    return pivot_agg(typed, keys, pivot_col, values, {value_col: "sum"}, renames)
