"""Timestamp parsing and formatting helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats tried in order when a column holds timestamps written by different producers.
DEFAULT_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd",
)


def parse_timestamp(c: Column, formats: Sequence[str] = DEFAULT_FORMATS) -> Column:
    """First format that parses wins; unparsable values become NULL (never an error)."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def batch_id(ts: Column) -> Column:
    """Batch id text ``yyyyMMdd_HHmmss_ffffff`` from a timestamp column."""
    return F.date_format(ts, "yyyyMMdd_HHmmss_SSSSSS")
