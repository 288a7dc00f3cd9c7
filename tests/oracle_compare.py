"""Run a contract query in Spark and its SQL in DuckDB and compare results.

Order-insensitive: both sides are sorted on all columns after normalising
values (dates to ISO text, floats kept exact unless ``tol`` is given).
Usable from pytest and from the command line::

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


_SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                  "date": "DATE", "boolean": "BOOLEAN", "smallint": "SMALLINT", "float": "FLOAT"}


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (2, "")  # not the same as NULL
        return (1, repr(v + 0.0))
    if isinstance(v, (dt.date, dt.datetime)):
        return (1, v.isoformat())
    if isinstance(v, bool):
        return (1, str(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    return (1, str(v))


def compare(spark, name: str, sf_dir: str) -> tuple[bool, str]:
    from __spark_entry__ import oracle_sql, queries

    sdf = queries()[name](spark, sf_dir)
    s_cols = sorted(sdf.columns)
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in sdf.collect()]
    con = duck(sf_dir)
    rel = con.sql(oracle_sql()[name])
    d_cols = rel.columns
    if sorted(d_cols) != s_cols:
        return False, f"columns differ: spark={s_cols} duckdb={sorted(d_cols)}"
    s_types = {f.name: _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields}
    d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
    bad_types = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    if bad_types:
        return False, f"types differ (spark, duckdb): {bad_types}"
    idx = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(_norm(row[i]) for i in idx) for row in rel.fetchall()]
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} duckdb={len(d_rows)}"
    s_rows.sort()
    d_rows.sort()
    for a, b in zip(s_rows, d_rows):
        if a != b:
            return False, f"first differing row: spark={a} duckdb={b}"
    return True, f"{len(s_rows)} rows equal"


def main(argv):
    from lakemart.session import get_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(master="local[8]", shuffle_partitions=8)
    from __spark_entry__ import queries

    names = argv[2:] or list(queries())
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, n, sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {n}: {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} equal")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
