"""The registered text operators that SQL can express, against their DuckDB SQL."""

import pytest

from lakemart.llm.queries import SQL
from tests.oracle_compare import compare


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf001, name):
    ok, msg = compare(spark, name, sf001)
    assert ok, msg
