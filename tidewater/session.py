"""Session construction and shared-storage helpers.

Library functions never create a session themselves; they take DataFrames and return
DataFrames. ``build_session`` is for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidewater") -> SparkSession:
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    shuffle_partitions = shuffle_partitions or max(8, cpus * 2)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDEWATER_DRIVER_MEMORY", "16g"))
        .config("spark.sql.sources.partitionOverwriteMode", "static")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    The setting is read from the session. On a local master a folder is made under the system
    temp dir where it is unset; on a cluster that folder would differ from machine to machine,
    so an unset setting is an error there.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if not conf_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, inside the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Same failure guarantees as ``checkpoint()`` (the files are in shared storage), but
    columnar and compressed, and later scans get column pruning and filter pushdown.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder through the cluster's file system."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)  # noqa: SLF001


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster's file system (any Hadoop-supported scheme)."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)  # noqa: SLF001
