"""High-water-mark increments: read the mark, extract rows above it, advance the mark.

The mark store is a small Parquet table ``(name, mark)`` in shared storage. The mark is
written *after* the increment has been written and validated, so a failed run repeats the
same increment instead of skipping it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import materialize, path_exists

EPOCH = dt.datetime(1970, 1, 1)
MARK_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("mark", T.StringType()),
    T.StructField("written_at", T.TimestampType()),
])


def ts_literal(mark: dt.datetime | str, dtype: T.DataType):
    """A mark as a literal of the column's own type. Python datetimes go through their ISO
    text, so a driver in another time zone cannot shift a ``timestamp_ntz`` comparison."""
    text = mark.isoformat(sep=" ") if isinstance(mark, dt.datetime) else str(mark)
    return F.lit(text).cast(dtype)


def read_mark(spark: SparkSession, marks_path: str, name: str) -> dt.datetime:
    """Last mark for ``name``; a missing store, missing row or unparsable value → 1970-01-01."""
    if not path_exists(spark, marks_path):  # no store yet: start from the epoch
        return EPOCH
    marks = spark.read.schema(MARK_SCHEMA).parquet(marks_path)
    row = (
        marks.filter(F.col("name") == name)
        .select(F.try_to_timestamp(F.col("mark")).cast("timestamp_ntz").alias("m"), "written_at")
        .orderBy(F.col("written_at").desc_nulls_last())
        .limit(1)
        .collect()
    )
    if not row or row[0]["m"] is None:
        return EPOCH
    return row[0]["m"]


def write_mark(spark: SparkSession, marks_path: str, name: str, mark: dt.datetime | str) -> None:
    """Append the new mark (single writer per name: one scheduled run at a time)."""
    value = mark.isoformat() if isinstance(mark, dt.datetime) else str(mark)
    spark.createDataFrame([(name, value, dt.datetime.now(dt.timezone.utc))], MARK_SCHEMA) \
        .coalesce(1).write.mode("append").parquet(marks_path)


def cap_boundary(times: DataFrame, limit: int) -> tuple[object, int] | None:
    """The earliest time at which ``limit`` rows are reached, and the rows before it; None if
    there are not that many. ``times`` has one column.

    Rows are counted per distinct time (partial aggregates) and the counts sorted by range. Only
    one number a range comes to the driver, and the running sum is taken in the single range
    that holds the boundary.
    """
    (name,) = times.columns
    counts = times.groupBy(name).agg(F.count(F.lit(1)).alias("n")).orderBy(name)
    ranged = materialize(counts.withColumn("part", F.spark_partition_id()), "increment_counts")
    before = 0
    for r in ranged.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        if before + r["n"] >= limit:
            running = F.sum("n").over(Window.orderBy(name))
            hit = (ranged.filter(F.col("part") == r["part"]).select(name, "n", running.alias("upto"))
                   .filter(F.col("upto") + before >= limit).orderBy(name).first())
            return hit[name], before + hit["upto"] - hit["n"]
        before += r["n"]
    return None


def incremental_extract(df: DataFrame, ts_col: str, mark: dt.datetime | str, limit: int | None = None,
                        exact: bool = False, tie_cols: Sequence[str] = ()) -> DataFrame:
    """Rows with ``ts_col > mark``; with ``limit``, the earliest ones up to that many.

    By default every row that ties with the last timestamp under the cap is kept
    (``rank() <= n``), so advancing the mark to the max never skips rows. ``exact=True`` gives
    the rows of a plain ``ORDER BY ts, tie_cols LIMIT n``. NULL timestamps never qualify. Rows
    come in no particular order.
    """
    m = ts_literal(mark, df.schema[ts_col].dataType)
    cand = df.filter(F.col(ts_col) > m)
    found = cap_boundary(cand.select(ts_col), limit) if limit is not None else None
    if found is None:
        return cand
    last, before = F.lit(found[0]).cast(df.schema[ts_col].dataType), found[1]
    if not exact:
        return cand.filter(F.col(ts_col) <= last)
    # only the ties of one timestamp are ordered
    ties = cand.filter(F.col(ts_col) == last).orderBy(*[F.col(c).asc_nulls_last() for c in tie_cols]).limit(limit - before)
    return cand.filter(F.col(ts_col) < last).unionByName(ties)


def advance_mark(increment: DataFrame, ts_col: str, mark: dt.datetime | str) -> DataFrame:
    """One row: rows in the increment and the new mark (max timestamp, old mark when empty)."""
    m = ts_literal(mark, increment.schema[ts_col].dataType)
    return increment.agg(
        F.count(F.lit(1)).alias("rows_extracted"),
        F.coalesce(F.max(ts_col), m).alias("new_mark"),
    )
