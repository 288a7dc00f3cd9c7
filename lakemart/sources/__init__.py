"""Readers with explicit schemas, and partitioned parquet sinks."""
