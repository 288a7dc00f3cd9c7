"""Incremental (monthly/daily) refresh of the fact table with Structured Streaming."""

from lakemart.streaming.merge import merge_batch, start_merge
from lakemart.streaming.refresh import refresh_months, start_refresh

__all__ = ["merge_batch", "refresh_months", "start_merge", "start_refresh"]
