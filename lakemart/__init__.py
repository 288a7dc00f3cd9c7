"""lakemart: a Spark-native data-mart toolkit.

Raw travel, place and climate files are read with explicit schemas, cleaned,
deduplicated and rolled up into one fact table (month x airport) and three
dimension tables.  Every transform is a plain DataFrame expression, so
Catalyst sees and optimises the whole plan; there is no Python UDF anywhere
in the library.

Layout
------
``sources``    readers (explicit schemas) and sinks (partitioned parquet)
``functions``  Column -> Column scalar functions (casts, codes, dates, ...)
``operators``  aggregates, joins, set operations and data-quality checks
``plans``      the table builders and the end-to-end pipeline
``streaming``  incremental refresh of the fact table
"""

from lakemart.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
__version__ = "0.1.0"
