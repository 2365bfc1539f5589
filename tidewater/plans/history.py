"""Versioned-table queries over a change log derived from ``events``.

Log: key ``user_id``; one commit per day (id ``yyyymmdd``, committed at the next midnight);
``seq`` = event_id; op = 'D' for error events, 'I' for signups, 'U' otherwise.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import versionlog as L
from tidewater.operators import versions as V
from tidewater.plans.registry import query
from tidewater.session import shared_dir
from tidewater.tables import table

KEY = "user_id"
VERSION = 20240115
OLD, NEW = 20240110, 20240120
AS_OF_TS = "2024-01-20 00:00:00"
KEEP_SINCE = 20240115
ROLLBACK_TS = "2099-01-01 00:00:00"

LOG_SQL = """log AS (
  SELECT CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS commit_id,
         CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) AS commit_ts,
         event_id AS seq,
         CASE event_type WHEN 'error' THEN 'D' WHEN 'signup' THEN 'I' ELSE 'U' END AS op,
         user_id, event_type, value, ts, props
  FROM events)"""


def state_sql(where: str) -> str:
    return f"""SELECT user_id, event_type, value, ts, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY commit_id DESC, seq DESC) AS rn
  FROM log WHERE {where}) WHERE rn = 1 AND op <> 'D'"""


def event_log(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.date_format("ts", "yyyyMMdd").cast("bigint").alias("commit_id"),
        F.date_add(F.to_date("ts"), 1).cast("timestamp_ntz").alias("commit_ts"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", "D").when(F.col("event_type") == "signup", "I")
        .otherwise("U").alias("op"),
        "user_id", "event_type", "value", "ts", "props",
    )


@query("as_of_version", f"WITH {LOG_SQL} {state_sql(f'commit_id <= {VERSION}')}")
def q_as_of_version(spark, sf_dir):
    return V.as_of_version(event_log(spark, sf_dir), KEY, VERSION)


_TS_WHERE = f"commit_ts <= TIMESTAMP '{AS_OF_TS}'"


@query("as_of_timestamp", f"WITH {LOG_SQL} {state_sql(_TS_WHERE)}")
def q_as_of_timestamp(spark, sf_dir):
    return V.as_of_timestamp(event_log(spark, sf_dir), KEY, AS_OF_TS)


@query("snapshot_history", f"""WITH {LOG_SQL}
SELECT commit_id, max(commit_ts) AS commit_ts, lag(commit_id) OVER (ORDER BY commit_id) AS parent_id,
       count(*) AS n_changes, count_if(op = 'I') AS n_inserts, count_if(op = 'U') AS n_updates,
       count_if(op = 'D') AS n_deletes, commit_id = max(commit_id) OVER () AS is_current
FROM log GROUP BY commit_id""")
def q_snapshot_history(spark, sf_dir):
    return V.snapshot_history(event_log(spark, sf_dir))


BASE_EVERY = 4


def stored_log(spark, sf_dir):
    """The log stored in two appends, up to ``VERSION`` and after it."""
    log, path = event_log(spark, sf_dir), shared_dir(spark, "version_log")
    L.append_changes(log.filter(F.col("commit_id") <= VERSION), path, [KEY], BASE_EVERY)
    L.append_changes(log.filter(F.col("commit_id") > VERSION), path, [KEY], BASE_EVERY)
    return path


@query("stored_as_of_version", f"WITH {LOG_SQL} {state_sql(f'commit_id <= {NEW}')}")
def q_stored_as_of_version(spark, sf_dir):
    """A version read from the base at ``VERSION`` and the commits after it."""
    return L.state(spark, stored_log(spark, sf_dir), [KEY], NEW)


@query("stored_as_of_timestamp", f"WITH {LOG_SQL} {state_sql(f"commit_ts <= TIMESTAMP '{AS_OF_TS}'")}")
def q_stored_as_of_timestamp(spark, sf_dir):
    return L.state_at_time(spark, stored_log(spark, sf_dir), [KEY], AS_OF_TS)


@query("stored_commits", f"WITH {LOG_SQL} SELECT commit_id, count(*) AS n_changes FROM log GROUP BY commit_id")
def q_stored_commits(spark, sf_dir):
    """The commits and their sizes, from the manifest alone."""
    return L.commits(spark, stored_log(spark, sf_dir)).select("commit_id", "n_changes")


@query("stored_rollback", f"WITH {LOG_SQL} {state_sql(f'commit_id <= {OLD}')}")
def q_stored_rollback(spark, sf_dir):
    """The state after a compensating commit back to ``OLD``."""
    path = stored_log(spark, sf_dir)
    L.rollback(spark, path, [KEY], OLD, ROLLBACK_TS)
    return L.state(spark, path, [KEY])


@query("stored_expired", f"""WITH {LOG_SQL}
SELECT 'kept' AS part, commit_id, count(*) AS n FROM log WHERE commit_id >= {NEW} GROUP BY commit_id
UNION ALL SELECT 'state', {NEW}, count(*) FROM ({state_sql(f'commit_id <= {NEW}')})""")
def q_stored_expired(spark, sf_dir):
    """What is left of the log after expiring what is older than ``NEW``, and the size of the state at ``NEW``."""
    path = stored_log(spark, sf_dir)
    L.expire(spark, path, [KEY], NEW)
    at = L.state(spark, path, [KEY], NEW).agg(F.count(F.lit(1)).alias("n"))
    return L.commits(spark, path).select(F.lit("kept").alias("part"), "commit_id", F.col("n_changes").alias("n")).unionByName(
        at.select(F.lit("state").alias("part"), F.lit(NEW).cast("bigint").alias("commit_id"), "n"))


@query("snapshot_diff", f"""WITH {LOG_SQL},
  a AS ({state_sql(f'commit_id <= {OLD}')}),
  b AS ({state_sql(f'commit_id <= {NEW}')})
SELECT coalesce(a.user_id, b.user_id) AS user_id,
       CASE WHEN a.user_id IS NULL THEN 'insert' WHEN b.user_id IS NULL THEN 'delete' ELSE 'update' END
         AS operation,
       a.event_type AS old_event_type, a.value AS old_value, a.ts AS old_ts, a.props AS old_props,
       b.event_type AS new_event_type, b.value AS new_value, b.ts AS new_ts, b.props AS new_props
FROM a FULL OUTER JOIN b ON a.user_id = b.user_id
WHERE a.user_id IS NULL OR b.user_id IS NULL
   OR a.event_type IS DISTINCT FROM b.event_type OR a.value IS DISTINCT FROM b.value
   OR a.ts IS DISTINCT FROM b.ts OR a.props IS DISTINCT FROM b.props""")
def q_snapshot_diff(spark, sf_dir):
    log = event_log(spark, sf_dir)
    return V.snapshot_diff(V.as_of_version(log, KEY, OLD), V.as_of_version(log, KEY, NEW), KEY)


@query("rollback_to", f"WITH {LOG_SQL} {state_sql(f'commit_id <= {OLD}')}")
def q_rollback_to(spark, sf_dir):
    """Current state after rolling back to ``OLD`` equals the state at ``OLD``."""
    return V.current(V.rollback_to(event_log(spark, sf_dir), KEY, OLD), KEY)


@query("expire_versions", f"""WITH {LOG_SQL}
SELECT (SELECT max(commit_id) FROM log WHERE commit_id < {KEEP_SINCE}) AS commit_id,
       (SELECT max(commit_ts) FROM log WHERE commit_id < {KEEP_SINCE}) AS commit_ts,
       seq, 'I' AS op, user_id, event_type, value, ts, props
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY commit_id DESC, seq DESC) AS rn
      FROM log WHERE commit_id < {KEEP_SINCE}) WHERE rn = 1 AND op <> 'D'
UNION ALL
SELECT * FROM log WHERE commit_id >= {KEEP_SINCE}""")
def q_expire_versions(spark, sf_dir):
    return V.expire_versions(event_log(spark, sf_dir), KEY, KEEP_SINCE)


def _json_sql(alias: str) -> str:
    """The audit JSON text as Spark's to_json writes it (field order, microsecond time)."""
    return (f"""CASE WHEN {alias}.user_id IS NOT NULL THEN '{{"event_type":"' || {alias}.event_type """
            f"""|| '","value":' || CAST({alias}.value AS VARCHAR) """
            f"""|| ',"ts":"' || strftime({alias}.ts, '%Y-%m-%dT%H:%M:%S.%f') """
            f"""|| '","props":"' || replace({alias}.props, '"', '\\"') || '"}}' END""")


@query("audit_log", f"""WITH {LOG_SQL},
  a AS ({state_sql(f'commit_id <= {OLD}')}),
  b AS ({state_sql(f'commit_id <= {NEW}')})
SELECT 'events' AS table_name,
       CASE WHEN a.user_id IS NULL THEN 'INSERT' WHEN b.user_id IS NULL THEN 'DELETE' ELSE 'UPDATE' END
         AS operation,
       CAST(coalesce(a.user_id, b.user_id) AS VARCHAR) AS record_key,
       {_json_sql('a')} AS old_value, {_json_sql('b')} AS new_value,
       'tidewater' AS changed_by, TIMESTAMP '{AS_OF_TS}' AS changed_at
FROM a FULL OUTER JOIN b ON a.user_id = b.user_id
WHERE a.user_id IS NULL OR b.user_id IS NULL
   OR a.event_type IS DISTINCT FROM b.event_type OR a.value IS DISTINCT FROM b.value
   OR a.ts IS DISTINCT FROM b.ts OR a.props IS DISTINCT FROM b.props""")
def q_audit_log(spark, sf_dir):
    """Audit rows (old/new values as JSON) for the change between two versions."""
    log = event_log(spark, sf_dir)
    diff = V.snapshot_diff(V.as_of_version(log, KEY, OLD), V.as_of_version(log, KEY, NEW), KEY)
    return V.audit_rows(diff, KEY, "events", "tidewater", F.lit(AS_OF_TS).cast("timestamp_ntz"))
