"""File metadata, compaction planning and compaction of small Parquet files.

``file_stats`` reads only the hidden ``_metadata`` struct, so no data column is decoded.
Compaction works on a published table (``sources.published``): it stages the rewritten files,
checks their rows per partition, and publishes them together with the untouched files in one step.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.sizing import broadcast_if_small
from tidewater.session import materialize
from tidewater.sources.published import (Version, commit, live_files, read_files, relative_file, stage,
                                         version_at)

# Target file size and the least number of files worth rewriting.
TARGET_BYTES = 64 * 1024 * 1024
MIN_INPUT_FILES = 5

# Files that one task packs at most (about), and bins that it keeps open.
PACK_FILES = 100_000
LOOK_BACK = 1_000


def file_stats(df: DataFrame, partition_cols: Sequence[str] = ()) -> DataFrame:
    """One row per data file: path, size in bytes, record count and partition values."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        *[F.col(c) for c in partition_cols],
    ).agg(F.count(F.lit(1)).alias("record_count"))


def file_totals(stats: DataFrame) -> DataFrame:
    """File count and ``COALESCE(SUM(size), 0)``."""
    return stats.agg(F.count(F.lit(1)).alias("file_count"),
                     F.coalesce(F.sum("file_size"), F.lit(0)).alias("total_bytes"))


def file_distribution(stats: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Files, bytes, records and average file size per partition."""
    return stats.groupBy(*partition_cols).agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("file_size").alias("total_bytes"),
        F.sum("record_count").alias("record_count"),
        F.round(F.avg("file_size"), 2).alias("avg_file_bytes"),
    )


def largest_files(stats: DataFrame, n: int = 10) -> DataFrame:
    """Top-n files by size (the report limit is the feature)."""
    return stats.orderBy(F.col("file_size").desc(), F.col("file_path")).limit(n)


def pack(sizes: Sequence[int], target: int, look_back: int = LOOK_BACK) -> list[int]:
    """Bin number of each size, by best fit in the order given: the open bin that is left with the
    least room, else a new one. Beyond ``look_back`` open bins the fullest is closed."""
    room: list[tuple[int, int]] = []
    out, bins = [], 0
    for size in sizes:
        at = bisect_left(room, (size,))
        if at < len(room):
            left, number = room.pop(at)
        else:
            left, number = target, bins
            bins += 1
        out.append(number)
        if left > size:
            insort(room, (left - size, number))
            if len(room) > look_back:
                room.pop(0)
    return out


def binned_files(stats: DataFrame, partition_cols: Sequence[str], size_col: str = "file_size",
                 file_col: str = "file_path", target_bytes: int = TARGET_BYTES,
                 min_input_files: int = MIN_INPUT_FILES, rewrite_all: bool = False,
                 pack_files: int = PACK_FILES, look_back: int = LOOK_BACK) -> DataFrame:
    """The files worth rewriting, each with its ``bin``: best fit by falling size up to the target.

    Files at or above the target are left alone, and so are bins with fewer than
    ``min_input_files`` files (unless ``rewrite_all``). A partition of more than ``pack_files``
    files is packed in shares, dealt by a hash of the name, so that no task holds more than about
    that many; each share costs at most one bin more. Equal sizes go by name.
    """
    cand = stats if rewrite_all else stats.filter(F.col(size_col) < target_bytes)
    cand = materialize(cand, "pack_input")
    parts = [F.col(c).eqNullSafe(F.col(f"_of{i}")) for i, c in enumerate(partition_cols)]
    shares = F.ceil(F.count(F.lit(1)) / F.lit(pack_files)).cast("int").alias("_shares")
    counts = cand.groupBy(*[F.col(c).alias(f"_of{i}") for i, c in enumerate(partition_cols)]).agg(shares)
    if partition_cols:
        joined = cand.join(broadcast_if_small(counts), reduce(Column.__and__, parts))
    else:
        joined = cand.withColumn("_shares", counts.scalar())
    dealt = joined.withColumn("_share", F.pmod(F.xxhash64(file_col), F.col("_shares")).cast("int")).select(*cand.columns, "_share")

    def pack_share(files: pd.DataFrame) -> pd.DataFrame:
        files = files.sort_values([size_col, file_col], ascending=[False, True])
        share = int(files["_share"].iloc[0]) << 32
        return files.drop(columns="_share").assign(bin=[share + b for b in pack(files[size_col].tolist(), target_bytes, look_back)])

    schema = T.StructType([*cand.schema.fields, T.StructField("bin", T.LongType())])
    binned = dealt.groupBy(*partition_cols, "_share").applyInPandas(pack_share, schema)
    if rewrite_all:
        return binned
    files = F.count(F.lit(1)).over(Window.partitionBy(*partition_cols, "bin"))
    return binned.withColumn("_files", files).filter(F.col("_files") >= min_input_files).drop("_files")


def compaction_plan(stats: DataFrame, partition_cols: Sequence[str], size_col: str = "file_size",
                    file_col: str = "file_path", target_bytes: int = TARGET_BYTES,
                    min_input_files: int = MIN_INPUT_FILES, rewrite_all: bool = False) -> DataFrame:
    """One row per bin that a compaction would rewrite."""
    binned = binned_files(stats, partition_cols, size_col, file_col, target_bytes, min_input_files, rewrite_all)
    return binned.groupBy(*partition_cols, "bin").agg(
        F.count(F.lit(1)).alias("input_files"),
        F.sum(size_col).alias("input_bytes"),
        F.min(file_col).alias("first_file"),
        F.max(file_col).alias("last_file"),
    )


def compact_table(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES,
                  min_input_files: int = MIN_INPUT_FILES, rewrite_all: bool = False) -> Version:
    """Publish a version of a published table whose small files are packed; returns the live version.

    Files are packed by their real sizes into bins of about ``target_bytes``; only rows of
    packed files are read and shuffled, by bin, and stay in the order of their files. All other
    files are named again by the new version and not touched. A bin is one task and one file, so a
    partition that holds a third of the data is many tasks, whatever its rows are.

    Readers see the old files until the new version is published, in one step, after the rewritten
    rows were checked per partition. A job that stops before that changes nothing and can be run
    again; one that finds another version published meanwhile raises ``CommitConflict``.
    """
    base = version_at(spark, path)
    if base is None:
        raise FileNotFoundError(f"{path} holds no published version")
    live = live_files(spark, path, base)
    names = [f"_p{i}" for i in range(len(base.partition_cols))]
    flat = live.select("file", "bytes", "rows", *[F.col("partition")[c].alias(n) for c, n in zip(base.partition_cols, names, strict=True)])
    packed = materialize(binned_files(flat, names, "bytes", "file", target_bytes, min_input_files, rewrite_all), "file_bins")
    chosen = [r["file"] for r in packed.select("file").collect()]  # the scan's own file list, on the driver as any
    if not chosen:
        return base
    # bins numbered without gaps: a bin is one shuffle partition
    bin_key = F.struct(*names, "bin")
    bins = packed.select(bin_key.alias("_bin")).distinct()
    numbers = materialize(bins.orderBy("_bin").coalesce(1).select("_bin", F.monotonically_increasing_id().cast("int").alias("_slot")), "bins")
    of_file = materialize(packed.select(F.col("file").alias("_file"), bin_key.alias("_bin")).join(broadcast_if_small(numbers), "_bin")
                          .select("_file", "_slot"), "file_slots")
    rows = read_files(spark, path, base, chosen, {"_file": relative_file(), "_row": F.col("_metadata.row_index")})
    slotted = rows.join(broadcast_if_small(of_file), "_file")
    moved = slotted.repartitionByRange(numbers.count(), "_slot").sortWithinPartitions("_slot", "_file", "_row")
    staged = materialize(stage(moved.select(*base.schema.names), path, base.partition_cols, base.number + 1), "staged_files")
    before = packed.groupBy(F.struct(*names).alias("was") if names else F.lit(None).alias("was")).agg(F.sum("rows").alias("n"))
    after = staged.groupBy(F.struct(*[F.col("partition")[c].alias(n) for c, n in zip(base.partition_cols, names, strict=True)]).alias("now")
                           if names else F.lit(None).alias("now")).agg(F.sum("rows").alias("m"))
    if not before.join(after, F.col("was").eqNullSafe(F.col("now")), "full_outer").filter(~F.col("n").eqNullSafe(F.col("m"))).isEmpty():
        raise RuntimeError(f"compaction of {path} lost or added rows")
    kept = live.join(broadcast_if_small(packed.select("file")), "file", "left_anti")
    return commit(spark, path, kept.unionByName(staged), base.schema, base.partition_cols, "compact", base.number + 1,
                  base.properties)


def compaction_integrity(before: DataFrame, after: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """Per group: rows and ``ROUND(AVG(value), 2)`` before and after, and whether they match."""
    def agg(df, sfx):
        return df.groupBy(group_col).agg(
            F.count(F.lit(1)).alias(f"rows_{sfx}"),
            F.round(F.avg(value_col), 2).alias(f"avg_{sfx}"))

    j = agg(before, "before").join(agg(after, "after"), group_col, "full_outer")
    return j.withColumn("match", F.col("rows_before").eqNullSafe(F.col("rows_after"))
                        & F.col("avg_before").eqNullSafe(F.col("avg_after")))


def small_files_target(total_bytes: int, target_bytes: int) -> int:
    return max(1, math.ceil(total_bytes / target_bytes))
