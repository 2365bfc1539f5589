"""Size checks that guard broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper bound, in bytes, of a side that may be broadcast.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def plan_bytes(df: DataFrame) -> int:
    """The planner's size estimate: real file sizes at the scans, upper bounds above them.
    Nothing is run for it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # noqa: SLF001


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast only below the byte bound; above it the plan keeps a shuffle join
    (with adaptive skew splitting)."""
    return F.broadcast(df) if plan_bytes(df) <= max_bytes else df
