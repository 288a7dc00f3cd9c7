"""Every contract query against its DuckDB SQL (exact values, names and types)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lakemart.plans.contract import QUERIES
from tests.oracle_compare import compare

NAMES = list(QUERIES)


def test_every_query_has_sql():
    assert set(NAMES) <= set(oracle_sql())
    assert set(NAMES) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_sf0001(spark, sf001, name):
    ok, msg = compare(spark, name, sf001)
    assert ok, msg


@pytest.mark.parametrize("name", ["fact_wide", "count_map_countries", "distinct_median",
                                  "pivot_join", "snowflake_join", "clean_trips"])
def test_query_matches_oracle_sf001(spark, sf01, name):
    ok, msg = compare(spark, name, sf01)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry(spark)
    schema = df.schema
    rows = df.collect()
    assert len(rows) > 0
    assert entry(spark).schema == schema
