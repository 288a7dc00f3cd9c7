"""Set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_all(frames: Sequence[DataFrame], by_name: bool = True,
              allow_missing_columns: bool = False) -> DataFrame:
    """N-way UNION ALL.

    ``by_name=True`` (default) lines columns up by name, which is safe for
    files whose columns come in different orders; ``by_name=False`` unions by
    position like the original job.  Prefer one directory read over a union of
    per-file reads where the files share a layout.
    """
    frames = list(frames)
    if not frames:
        raise ValueError("union_all needs at least one frame")
    if by_name:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing_columns), frames)
    return reduce(lambda a, b: a.union(b), frames)
