"""Writers: batch Parquet, landing folders, JSON Lines, CSV, appends and overwrites.

Each writer returns a *manifest* (path, rows, time) instead of data, so steps hand over only
paths and counts. Counts come from reading the written files back, which also proves the
write is readable.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import path_exists

BATCH_ID_FORMAT = "%Y%m%d_%H%M%S_%f"
# text formats keep microseconds so a write/read round trip is lossless
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TEXT_OPTIONS = {"timestampNTZFormat": TS_FORMAT, "timestampFormat": TS_FORMAT + "XXX"}

MANIFEST_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("written_at", T.TimestampType()),
])


def default_batch_id(now: dt.datetime | None = None) -> str:
    return (now or dt.datetime.now(dt.timezone.utc)).strftime(BATCH_ID_FORMAT)


def batch_path(base: str, prefix: str, batch_id: str) -> str:
    return os.path.join(base, f"{prefix}_{batch_id}")


def write_batch(df: DataFrame, base: str, batch_id: str | None = None, prefix: str = "deduped",
                partition_by: Sequence[str] = (), compression: str = "snappy") -> str:
    """Write one batch to ``base/prefix_batchid``; overwriting the same batch is idempotent."""
    path = batch_path(base, prefix, batch_id or default_batch_id())
    w = df.write.mode("overwrite").option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def manifest(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """One-row manifest of a written location (row count read back from the files)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    if fmt in ("csv", "json"):
        r = r.options(**TEXT_OPTIONS)
    n = r.load(path).agg(F.count(F.lit(1)).alias("rows"))
    return n.select(F.lit(path).alias("path"), "rows", F.current_timestamp().alias("written_at"))


def write_landing(df: DataFrame, base: str, table_name: str, ingest_date: str | Column | None = None) -> str:
    """Date-foldered landing: ``base/<table>/ingest_date=<ds>/part-*.parquet``."""
    path = os.path.join(base, table_name)
    ds = ingest_date if ingest_date is not None else F.current_date().cast("string")
    col = F.lit(ds) if isinstance(ds, str) else ds
    (df.withColumn("ingest_date", col).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("ingest_date").parquet(path))
    return path


def validate_landing(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The landing location must exist (else error); an empty increment is fine. One row."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"landing path missing: {path}")
    return manifest(spark, path, schema=schema).select(
        "path", "rows", F.lit(True).alias("exists"))


def write_jsonl(df: DataFrame, path: str) -> str | None:
    """JSON Lines, UTF-8, non-ASCII kept; for an empty input the folder holds no rows and None is
    returned. The input runs once: emptiness is read from what was written."""
    df.write.mode("overwrite").options(**TEXT_OPTIONS).option("encoding", "UTF-8").json(path)
    return None if df.sparkSession.read.text(path).isEmpty() else path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").options(**TEXT_OPTIONS).option("header", True).csv(path)
    return path


def insert_by_position(df: DataFrame, table_name: str, overwrite: bool = False) -> None:
    """``INSERT INTO table`` by position (column names are ignored, order matters)."""
    df.write.insertInto(table_name, overwrite=overwrite)


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Append by name: columns are put in the existing table's order, and must be the same set."""
    spark = df.sparkSession
    if path_exists(spark, path):
        there = spark.read.parquet(path).columns
        if sorted(there) != sorted(df.columns):
            raise ValueError(f"columns differ from the table's: {sorted(set(there) ^ set(df.columns))}")
        df = df.select(*there)
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def overwrite_static(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """INSERT OVERWRITE (static): the whole table is replaced by ``df``."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """INSERT OVERWRITE (dynamic): only partitions present in ``df`` are replaced."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
    return path


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan with an explicit schema when given (no footer inference)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)

