"""A stored change log with base snapshots, so that old and new versions are read from a few commits.

    log    the changes, a folder a commit          (published table, partitioned by commit)
    bases  whole states after some of the commits  (published table, partitioned by base_id)

Reading a version takes the nearest base at or before it and the commits between the two; the
manifests name their files, so earlier and later commits are neither listed nor opened. A base is
written whenever ``base_every`` commits have gathered since the last, so a read folds at most that
many, however long the log is. Bases only shorten reads: a job that dies between publishing changes
and writing the base leaves a right, slower table, and the next append catches up.

Commit ids rise, and so do commit times. The state logic is that of ``operators.versions``: the
latest change of a key decides, by (commit_id, seq); ops are 'I', 'U' and 'D'.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import versions as V
from tidewater.session import materialize
from tidewater.sources import published as P

BASE_EVERY = 20
# commit times as folder names that sort like the times
_TIME = "yyyyMMddHHmmssSSSSSS"
_COMMIT = ("commit_id", "commit_time")


def _time(ts: Column) -> Column:
    return F.date_format(ts, _TIME)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """(commit_id, commit_time, n_changes) of the log's commits, from its manifest alone."""
    version = P.version_at(spark, f"{path}/log")
    if version is None:
        return spark.createDataFrame([], "commit_id bigint, commit_time string, n_changes bigint")
    files = P.live_files(spark, f"{path}/log", version)
    return files.groupBy(F.col("partition.commit_id").alias("commit_id"), F.col("partition.commit_time").alias("commit_time")).agg(
        F.sum("rows").alias("n_changes"))


def base_ids(spark: SparkSession, path: str) -> list[int]:
    """Commits that have a base snapshot, ascending; at most one in ``base_every`` has."""
    version = P.version_at(spark, f"{path}/bases")
    if version is None:
        return []
    found = P.live_files(spark, f"{path}/bases", version).select(F.col("partition.base_id").alias("b")).distinct()
    return sorted(r["b"] for r in found.collect())


def changes(spark: SparkSession, path: str, after: int | None = None, upto: int | None = None) -> DataFrame:
    """Changes of the commits after ``after`` and up to ``upto``; only their files are read."""
    where = F.lit(True)
    if after is not None:
        where = where & (F.col("partition.commit_id") > after)
    if upto is not None:
        where = where & (F.col("partition.commit_id") <= upto)
    return P.read_published(spark, f"{path}/log", where=where).drop("commit_time")


def _known(spark: SparkSession, path: str, version: int | None) -> int:
    """The last commit at or before ``version`` (the last of all for None)."""
    listed = commits(spark, path)
    last = (listed if version is None else listed.where(F.col("commit_id") <= version)).agg(F.max("commit_id"), F.min("commit_id")).first()[0]
    first = base_ids(spark, path)[:1]
    if last is None and first and (version is None or version >= first[0]):
        return first[0]
    if last is None:
        raise ValueError(f"no commit of {path} is at or before {version}")
    return last


def _folded(spark: SparkSession, path: str, keys: Sequence[str], version: int) -> DataFrame:
    """The latest change of every key at ``version``, deletes included."""
    before = [b for b in base_ids(spark, path) if b <= version]
    later = changes(spark, path, before[-1] if before else None, version)
    if before:
        base = P.read_published(spark, f"{path}/bases", where=F.col("partition.base_id") == before[-1])
        later = base.drop("base_id").select(*later.columns).unionByName(later)
    return V.latest(later, list(keys))


def state(spark: SparkSession, path: str, keys: Sequence[str], version: int | None = None) -> DataFrame:
    """The rows (keys and row columns) after ``version``, by default after the last commit."""
    folded = _folded(spark, path, keys, _known(spark, path, version))
    return folded.filter(F.col("op") != "D").select(*keys, *V.row_columns(folded, keys))


def state_at_time(spark: SparkSession, path: str, keys: Sequence[str], ts: str) -> DataFrame:
    """The rows after the last commit at or before the time ``ts`` (text, as the log's times are)."""
    at = commits(spark, path).where(F.col("commit_time") <= _time(F.lit(ts).cast("timestamp_ntz"))).agg(F.max("commit_id")).first()[0]
    if at is None:
        raise ValueError(f"no commit of {path} is at or before {ts}")
    return state(spark, path, keys, at)


def write_base(spark: SparkSession, path: str, keys: Sequence[str], version: int | None = None) -> int:
    """Store the state after ``version`` as a base snapshot; returns its commit."""
    at = _known(spark, path, version)
    if at not in base_ids(spark, path):
        rows = _folded(spark, path, keys, at).filter(F.col("op") != "D").withColumn("base_id", F.lit(at).cast("bigint"))
        P.publish(rows, f"{path}/bases", ["base_id"])
    return at


def append_changes(log: DataFrame, path: str, keys: Sequence[str], base_every: int = BASE_EVERY) -> P.Version:
    """Publish the commits in ``log`` (commit_id, commit_ts, seq, op, keys, row columns), all at once.

    They must come after all stored commits. A base follows where enough commits have gathered.
    """
    spark = log.sparkSession
    rows = log.withColumn("commit_id", F.col("commit_id").cast("bigint"))
    # a commit becomes files of even size: a hot one is split, small ones are not scattered
    rows = materialize(rows.withColumn("commit_time", _time(F.col("commit_ts"))).hint("rebalance", "commit_id"), "commit")
    new = rows.groupBy("commit_id").agg(F.min("commit_time").alias("t"), F.max("commit_time").alias("t2"))
    span = new.agg(F.min("commit_id").alias("first"), F.min("t").alias("since"), F.count(F.lit(1)).alias("n"),
                   F.count_if(F.col("t") != F.col("t2")).alias("torn")).first()
    stored = commits(spark, path).agg(F.max("commit_id").alias("last"), F.max("commit_time").alias("until")).first()
    last_base = (base_ids(spark, path) or [None])[-1]
    last = max((x for x in (stored["last"], last_base) if x is not None), default=None)
    if span["torn"]:
        raise ValueError("a commit has more than one time")
    if span["n"] and last is not None and (span["first"] <= last or (stored["until"] or "") > span["since"]):
        raise ValueError(f"commits must come after {last} ({stored['until']}), not from {span['first']} ({span['since']})")
    version = P.publish(rows, f"{path}/log", _COMMIT)
    listed = commits(spark, path)
    waiting = (listed if last_base is None else listed.where(F.col("commit_id") > last_base)).count()
    if waiting >= base_every:
        write_base(spark, path, keys)
    return version


def rollback(spark: SparkSession, path: str, keys: Sequence[str], version: int, commit_ts: str, base_every: int = BASE_EVERY) -> int:
    """Append a compensating commit that brings the state back to ``version``; returns its id.

    Only the bases and commits next to ``version`` and to the end of the log are read.
    """
    last = _known(spark, path, None)
    schema = P.version_at(spark, f"{path}/log").schema
    old, now = state(spark, path, keys, version), state(spark, path, keys, last)
    diff = V.snapshot_diff(now, old, list(keys))
    gone = F.col("operation") == "delete"
    rows = [c for c in now.columns if c not in keys]
    comp = diff.select(F.lit(last + 1).cast("bigint").alias("commit_id"),
                       F.lit(commit_ts).cast(schema["commit_ts"].dataType).alias("commit_ts"),
                       F.lit(0).cast(schema["seq"].dataType).alias("seq"), F.when(gone, "D").otherwise("U").alias("op"), *keys,
                       *[F.when(gone, F.col(f"old_{c}")).otherwise(F.col(f"new_{c}")).alias(c) for c in rows])
    append_changes(comp.select(*[c for c in schema.names if c != "commit_time"]), path, keys, base_every)
    return last + 1


def expire(spark: SparkSession, path: str, keys: Sequence[str], keep_since: int) -> P.Version:
    """Forget the commits before ``keep_since``: the state before it becomes a base, and the log's next
    version no longer names the files of older commits. No change is rewritten."""
    old = commits(spark, path).where(F.col("commit_id") < keep_since).agg(F.max("commit_id")).first()[0]
    log = P.version_at(spark, f"{path}/log")
    if old is None:
        return log
    at = write_base(spark, path, keys, old)
    for name, col, least, op in (("log", "commit_id", keep_since, "expire"), ("bases", "base_id", at, "expire")):
        now = P.version_at(spark, f"{path}/{name}")
        files = P.live_files(spark, f"{path}/{name}", now).where(F.col(f"partition.{col}") >= least)
        made = P.commit(spark, f"{path}/{name}", files, now.schema, now.partition_cols, op, now.number + 1)
        log = made if name == "log" else log
    return log
