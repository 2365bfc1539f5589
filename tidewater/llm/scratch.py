"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.session import shared_dir


class Scratch:
    """Parquet tables below one fresh folder of the shared checkpoint folder.

    ``save`` writes a frame and reads it back: lineage is cut, a lost executor costs only the
    running tasks, and values that depend on partitioning (row numbers) are fixed once.
    ``drop`` removes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = shared_dir(spark, name)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        sc = self.spark.sparkContext
        for name in names:
            path = sc._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")  # noqa: SLF001
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)  # noqa: SLF001


def with_row_numbers(df: DataFrame, scratch: Scratch, name: str, column: str = "row") -> DataFrame:
    """``df`` saved with a unique long ``column`` in it (gaps are allowed, order is kept)."""
    from pyspark.sql import functions as F

    return scratch.save(df.withColumn(column, F.monotonically_increasing_id()), name)
