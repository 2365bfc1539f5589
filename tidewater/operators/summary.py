"""Group summaries, count reconciliation and small document builders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_summary(df: DataFrame, group_col: str, value_col: str, decimals: int | None = 6) -> DataFrame:
    """Per group: non-null count, sum (0 for an all-NULL group) and mean; NULL groups dropped.

    Hash aggregate with map-side partial aggregation, so a hot group is pre-aggregated in
    every task before the shuffle.
    """
    v = F.col(value_col)
    total = F.coalesce(F.sum(v), F.lit(0.0))
    mean = F.avg(v)
    if decimals is not None:
        total, mean = F.round(total, decimals), F.round(mean, decimals)
    return (
        df.filter(F.col(group_col).isNotNull())
        .groupBy(group_col)
        .agg(F.count(v).alias("n_values"), total.alias("sum_value"), mean.alias("mean_value"))
    )


def category_list(df: DataFrame, group_col: str) -> DataFrame:
    """The distinct categories, one a row, sorted (a range sort of the distinct values)."""
    return df.select(F.col(group_col).alias("category")).where(F.col(group_col).isNotNull()).distinct().orderBy("category")


def reconcile_counts(expected: DataFrame | int, actual: DataFrame) -> DataFrame:
    """Compare a declared (producer) row count with the consumer's count: one row."""
    if isinstance(expected, int):
        exp = F.lit(expected).cast("bigint")
    else:  # one-row frame (a manifest) whose first column is the declared count
        exp = expected.select(F.max(F.col(expected.columns[0])).cast("bigint")).scalar()
    out = actual.agg(F.count(F.lit(1)).alias("actual_rows")).select(
        exp.alias("expected_rows"), "actual_rows")
    return out.withColumn("match", F.col("expected_rows") == F.col("actual_rows"))


def assert_counts_match(expected: int, actual: DataFrame) -> int:
    """Raise when the consumer sees a different count than the producer declared."""
    n = actual.count()
    if n != expected:
        raise ValueError(f"row count mismatch: expected {expected}, got {n}")
    return n


def event_documents(df: DataFrame, id_col: str, text_template: str, text_cols: Sequence[str],
                    meta: dict[str, Column]) -> DataFrame:
    """Build (id, text, metadata map) documents from rows with ``format_string``/``create_map``."""
    pairs: list[Column] = []
    for k, c in meta.items():
        pairs += [F.lit(k), c.cast("string")]
    return df.select(
        F.col(id_col).cast("string").alias("id"),
        F.format_string(text_template, *[F.col(c) for c in text_cols]).alias("text"),
        F.create_map(*pairs).alias("metadata"),
    )


def keyword_filter(docs: DataFrame, keyword: str, text_col: str = "text") -> DataFrame:
    """Documents whose text contains ``keyword`` (case-sensitive substring)."""
    return docs.filter(F.col(text_col).contains(keyword))


def metadata_filter(docs: DataFrame, key: str, value: str, metadata_col: str = "metadata") -> DataFrame:
    """Documents whose metadata field ``key`` equals ``value``; a missing field does not."""
    return docs.filter(F.try_element_at(F.col(metadata_col), F.lit(key)) == value)
