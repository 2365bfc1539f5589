"""Catalog set-up and listing: namespaces, tables from the caller's specifications, properties.

Tables are Parquet tables in the session catalog. ``init_catalog`` is create-if-absent by
default; ``replace=True`` really drops and recreates.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

@dataclass(frozen=True)
class TableSpec:
    """What a table is created with: columns (DDL), partition column and file target in bytes."""

    columns: str
    partition_by: str
    target_bytes: int = 128 * 1024 * 1024


def create_namespace(spark: SparkSession, namespace: str) -> bool:
    """CREATE NAMESPACE IF NOT EXISTS; False (not an exception) when it fails."""
    try:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
        return True
    except Exception:  # noqa: BLE001
        return False


def init_catalog(spark: SparkSession, namespace: str, location: str, tables: Mapping[str, TableSpec],
                 replace: bool = False) -> list[str]:
    """Create the namespace and the given tables; existing tables are kept unless ``replace``."""
    create_namespace(spark, namespace)
    made = []
    for name, spec in tables.items():
        full = f"{namespace}.{name}"
        if replace:
            spark.sql(f"DROP TABLE IF EXISTS {full}")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {full} ({spec.columns}) USING parquet PARTITIONED BY ({spec.partition_by}) "
            f"LOCATION '{location}/{name}' "
            f"TBLPROPERTIES ('write.target-file-size-bytes' = '{spec.target_bytes}')"
        )
        made.append(full)
    return made


CATALOG_SCHEMA = T.StructType([
    T.StructField("namespace", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("is_partition", T.BooleanType()),
])


def catalog_state(spark: SparkSession, namespace: str) -> DataFrame:
    """Tables and columns of a namespace as a DataFrame (catalog metadata, driver-sized)."""
    rows = []
    for t in spark.catalog.listTables(namespace):
        for c in spark.catalog.listColumns(f"{namespace}.{t.name}"):
            rows.append((namespace, t.name, c.name, c.dataType, bool(c.isPartition)))
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def table_properties(spark: SparkSession, full_name: str) -> DataFrame:
    return spark.sql(f"SHOW TBLPROPERTIES {full_name}").select(
        F.col("key"), F.col("value"))


def generate_rows(spark: SparkSession, batches: int = 20, rows_per_batch: int = 500) -> DataFrame:
    """Demo rows for compaction tests: category = batch mod 4 (A..D), metric = id mod 100."""
    n = batches * rows_per_batch
    return spark.range(n).select(
        F.col("id").cast("int").alias("id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("event_ts"),
        F.element_at(F.array(*[F.lit(x) for x in "ABCD"]),
                     (F.floor(F.col("id") / rows_per_batch) % 4 + 1).cast("int")).alias("category"),
        (F.col("id") % 100).cast("double").alias("metric_value"),
        F.concat(F.lit("row "), F.col("id").cast("string")).alias("description"),
    )
