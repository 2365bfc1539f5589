"""Table versions without a table format: time travel, history, diff, rollback, expiry.

A versioned table is an append-only change log with columns
``commit_id, commit_ts, seq, op ('I' | 'U' | 'D'), key…, row…``. Every version is a
DataFrame derived from the log:

* state at version v = latest change per key among commits ``<= v``, minus deletes;
* rollback appends a *compensating* commit (the diff from the current state back to v),
  so history stays append-only and roll-forward is just another rollback;
* expiry folds everything older than a commit into one base commit.

The per-key "latest change" is a ``row_number() == 1`` window that Catalyst runs as a
partial group limit before the shuffle, so a key with a third of the log's changes is cut
down map-side.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

META = ("commit_id", "commit_ts", "seq", "op")


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def row_columns(log: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in log.columns if c not in META and c not in keys]


def latest(log: DataFrame, keys: list[str]) -> DataFrame:
    """The latest change of every key, by (commit_id, seq)."""
    w = Window.partitionBy(*keys).orderBy(F.col("commit_id").desc(), F.col("seq").desc())
    return log.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def state_at(log: DataFrame, keys: str | Sequence[str], upto: Column | None = None) -> DataFrame:
    """Table state (key + row columns) after all changes selected by ``upto``."""
    keys = _keys(keys)
    sel = log if upto is None else log.filter(upto)
    return latest(sel, keys).filter(F.col("op") != "D").select(*keys, *row_columns(log, keys))


def as_of_version(log: DataFrame, keys: str | Sequence[str], version: int) -> DataFrame:
    """``SELECT … VERSION AS OF version``."""
    return state_at(log, keys, F.col("commit_id") <= F.lit(version))


def _ts(value, dtype):
    # Python datetimes go through ISO text: no dependence on the driver's local time zone
    return F.lit(value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value).cast(dtype)


def as_of_timestamp(log: DataFrame, keys: str | Sequence[str], ts) -> DataFrame:
    """``SELECT … TIMESTAMP AS OF ts``: newest commit at or before ``ts`` (inclusive)."""
    t = _ts(ts, log.schema["commit_ts"].dataType)
    return state_at(log, keys, F.col("commit_ts") <= t)


def current(log: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    return state_at(log, keys)


def snapshot_history(log: DataFrame) -> DataFrame:
    """One row per commit: time, parent, change counts by kind, current flag.

    The aggregate is partial per task; the parent ``lag`` then runs over one row per
    commit (metadata-sized, like a table format's snapshot list).
    """
    per = log.groupBy("commit_id").agg(
        F.max("commit_ts").alias("commit_ts"),
        F.count(F.lit(1)).alias("n_changes"),
        F.count_if(F.col("op") == "I").alias("n_inserts"),
        F.count_if(F.col("op") == "U").alias("n_updates"),
        F.count_if(F.col("op") == "D").alias("n_deletes"),
    )
    w = Window.orderBy("commit_id")
    return per.select(
        "commit_id", "commit_ts",
        F.lag("commit_id").over(w).alias("parent_id"),
        "n_changes", "n_inserts", "n_updates", "n_deletes",
        (F.col("commit_id") == F.max("commit_id").over(Window.partitionBy())).alias("is_current"),
    )


def snapshot_diff(before: DataFrame, after: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Row-level diff of two states: operation insert/delete/update with old_* and new_*.

    Both sides are unique per key, so the full-outer join is one-to-one. Equality is
    null-safe (``<=>``); unchanged rows are dropped.
    """
    keys = _keys(keys)
    cols = [c for c in after.columns if c not in keys]
    a = before.select(*keys, *[F.col(c).alias(f"old_{c}") for c in cols], F.lit(True).alias("_a"))
    b = after.select(*keys, *[F.col(c).alias(f"new_{c}") for c in cols], F.lit(True).alias("_b"))
    j = a.join(b, keys, "full_outer")
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
    op = (F.when(F.col("_a").isNull(), "insert").when(F.col("_b").isNull(), "delete")
          .when(~same, "update"))
    return (j.withColumn("operation", op).filter(F.col("operation").isNotNull())
            .select(*keys, "operation", *[f"old_{c}" for c in cols], *[f"new_{c}" for c in cols]))


def audit_rows(diff: DataFrame, keys: str | Sequence[str], table_name: str, changed_by: str,
               changed_at: Column | None = None) -> DataFrame:
    """Audit-log rows (table, operation, key, old JSON, new JSON, who, when) from a diff."""
    keys = _keys(keys)
    old = [c for c in diff.columns if c.startswith("old_")]
    new = [c for c in diff.columns if c.startswith("new_")]
    # full timestamp precision in the JSON values (the default JSON format stops at millis)
    opts = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
            "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    as_json = lambda cs, pre: F.when(
        F.coalesce(*[F.col(c).isNotNull() for c in cs], F.lit(False)),
        F.to_json(F.struct(*[F.col(c).alias(c[len(pre):]) for c in cs]), opts))
    return diff.select(
        F.lit(table_name).alias("table_name"),
        F.upper("operation").alias("operation"),
        F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("record_key"),
        as_json(old, "old_").alias("old_value"),
        as_json(new, "new_").alias("new_value"),
        F.lit(changed_by).alias("changed_by"),
        (changed_at if changed_at is not None else F.current_timestamp()).alias("changed_at"),
    )


def rollback_to(log: DataFrame, keys: str | Sequence[str], version: int, commit_ts=None) -> DataFrame:
    """Append a compensating commit that brings the current state back to ``version``.

    Returns the new log. The compensating commit gets id ``max(commit_id) + 1``; rows that
    must reappear or change are written as 'U', rows that must vanish as 'D'.
    """
    keys = _keys(keys)
    rows = row_columns(log, keys)
    diff = snapshot_diff(current(log, keys), as_of_version(log, keys, version), keys)
    next_id = log.select(F.max("commit_id") + 1).scalar()
    ts = (_ts(commit_ts, log.schema["commit_ts"].dataType) if commit_ts is not None
          else log.select(F.max("commit_ts")).scalar())
    # deletes carry the old values (the row as it was), upserts the target values
    comp = diff.select(
        next_id.alias("commit_id"), ts.alias("commit_ts"),
        # one row per key inside the commit, so a constant seq is unambiguous
        F.lit(0).cast(log.schema["seq"].dataType).alias("seq"),
        F.when(F.col("operation") == "delete", "D").otherwise("U").alias("op"),
        *keys,
        *[F.when(F.col("operation") == "delete", F.col(f"old_{c}")).otherwise(F.col(f"new_{c}"))
          .alias(c) for c in rows],
    )
    return log.unionByName(comp.select(*log.columns))


def expire_versions(log: DataFrame, keys: str | Sequence[str], keep_since: int) -> DataFrame:
    """Fold every commit older than ``keep_since`` into one base commit of 'I' rows.

    States at versions ``>= keep_since`` are unchanged; older versions can no longer be read.
    """
    keys = _keys(keys)
    old = log.filter(F.col("commit_id") < keep_since)
    base_id = old.select(F.max("commit_id")).scalar()
    base_ts = old.select(F.max("commit_ts")).scalar()
    base = latest(old, keys).filter(F.col("op") != "D").select(
        base_id.alias("commit_id"), base_ts.alias("commit_ts"), "seq", F.lit("I").alias("op"),
        *keys, *row_columns(log, keys))
    return base.select(*log.columns).unionByName(log.filter(F.col("commit_id") >= keep_since))
