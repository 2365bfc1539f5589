"""Key-based deduplication, run statistics and upsert (last/first write wins).

Ordering rule (last write wins): per key the newest timestamp wins, a NULL timestamp loses,
and remaining ties go to the earliest input position. Spark has no implicit input order, so
the caller names ``order_by`` columns that define it (for files: ``_metadata.file_path`` and
``_metadata.row_index``).

All dedups are ``row_number() == 1`` over a key window. Catalyst turns that into a
``WindowGroupLimit`` that already runs *before* the shuffle, so a key that holds a third of
the rows is cut to one row per map partition before it is exchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STRATEGIES = ("last_write_wins", "first_write_wins")


def _as_list(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def _order_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in cols]


def validate_columns(df: DataFrame, keys: Sequence[str], ts_col: str | None = None) -> None:
    """Raise ``ValueError`` naming every required column that is missing (plan-time check)."""
    required = list(keys) + ([ts_col] if ts_col else [])
    present = set(df.columns)
    missing = sorted(c for c in set(required) if c not in present)
    if missing:
        raise ValueError(
            f"Missing required columns: {missing}. Keys: {list(keys)}, timestamp column: {ts_col}"
        )


def null_key_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: NULL count per key column, from a single aggregate pass."""
    return df.agg(*[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys])


def dedup_lww(df: DataFrame, keys: str | Sequence[str], ts_col: str,
              order_by: Sequence[str | Column] = ()) -> DataFrame:
    """Last write wins: newest ``ts_col`` per key, NULL timestamps lose, ties by ``order_by``."""
    keys = _as_list(keys)
    validate_columns(df, keys, ts_col)
    w = Window.partitionBy(*keys).orderBy(F.col(ts_col).desc_nulls_last(), *_order_cols(order_by))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dedup_fww(df: DataFrame, keys: str | Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """First write wins: the earliest row per key in input order ``order_by``."""
    keys = _as_list(keys)
    validate_columns(df, keys)
    if not order_by:
        raise ValueError("first_write_wins needs order_by columns that define input order")
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order_by))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dedup(df: DataFrame, keys: str | Sequence[str], ts_col: str = "updated_at",
          strategy: str = "last_write_wins", order_by: Sequence[str | Column] = ()) -> DataFrame:
    """Strategy dispatch; ``combine`` (documented but never implemented upstream) is rejected."""
    if strategy not in STRATEGIES:
        raise ValueError(f"Unsupported dedup strategy: {strategy}")
    if strategy == "last_write_wins":
        return dedup_lww(df, keys, ts_col, order_by)
    validate_columns(df, _as_list(keys), ts_col)
    return dedup_fww(df, keys, order_by)


def dedup_stats(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """One row: input_rows, unique_rows, duplicate_rows, pct_reduction.

    Two aggregates, both partial before the shuffle: per-key counts (a hot key collapses
    map-side), then totals. NULL keys form one group, as in the upstream pandas code.
    Empty input gives zeros and a 0.0 percentage.
    """
    keys = _as_list(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    totals = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("input_rows"),
        F.count(F.lit(1)).alias("unique_rows"),
    )
    return totals.select(
        "input_rows",
        "unique_rows",
        (F.col("input_rows") - F.col("unique_rows")).alias("duplicate_rows"),
        F.coalesce(
            F.round(F.try_divide((F.col("input_rows") - F.col("unique_rows")) * 100.0,
                                 F.col("input_rows")), 4),
            F.lit(0.0),
        ).alias("pct_reduction"),
    )


def dedup_batches(df: DataFrame, batch_col: str | Column, keys: str | Sequence[str], ts_col: str,
                  order_by: Sequence[str | Column] = (), strategy: str = "last_write_wins") -> DataFrame:
    """Dedup many batches in one job: the batch id joins the partition key.

    ``batch_col`` is a column name or an expression (then exposed as ``batch_id``).
    """
    if not isinstance(batch_col, str):
        df = df.withColumn("batch_id", batch_col)
        batch_col = "batch_id"
    return dedup(df, [batch_col, *_as_list(keys)], ts_col, strategy, order_by)


def upsert_lww(new: DataFrame, existing: DataFrame, keys: str | Sequence[str], ts_col: str,
               order_by: Sequence[str | Column] = ()) -> DataFrame:
    """existing ∪ new (columns united by name), then last write wins.

    A timestamp tie keeps the existing row (it comes first in the concatenation), then
    ``order_by`` decides.
    """
    keys = _as_list(keys)
    validate_columns(new, keys, ts_col)
    validate_columns(existing, keys, ts_col)
    both = existing.withColumn("_side", F.lit(0)).unionByName(
        new.withColumn("_side", F.lit(1)), allowMissingColumns=True
    )
    return dedup_lww(both, keys, ts_col, [F.col("_side").asc(), *_order_cols(order_by)]).drop("_side")


def dedup_and_write(df: DataFrame, keys: str | Sequence[str], base: str, ts_col: str = "updated_at",
                    strategy: str = "last_write_wins", order_by: Sequence[str | Column] = (),
                    batch_id: str | None = None, partition_by: Sequence[str] = ()) -> str | None:
    """One shot: dedup then write one batch; an empty input writes nothing and returns None."""
    from tidewater.sources.sinks import write_batch

    if df.isEmpty():
        return None
    return write_batch(dedup(df, keys, ts_col, strategy, order_by), base, batch_id,
                       partition_by=partition_by)
