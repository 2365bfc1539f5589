"""MERGE / UPDATE / DELETE, increments, overwrites and write-then-read queries."""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import dedup as D
from tidewater.operators import merge as M
from tidewater.operators import summary as S
from tidewater.plans.ingest import UPSERT_SPLIT, orders_split
from tidewater.plans.registry import query
from tidewater.session import shared_dir
from tidewater.sources import incremental as I
from tidewater.sources import sinks as K
from tidewater.tables import table

INCREMENT_MARK = "2000-01-01"
INCREMENT_CAP = 1_000  # cuts through rows of one timestamp

_SIDES = f"""
  t AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
          ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) rn
        FROM orders WHERE o_orderdate < TIMESTAMP '{UPSERT_SPLIT}') WHERE rn = 1),
  s AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
          ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) rn
        FROM orders WHERE o_orderdate >= TIMESTAMP '{UPSERT_SPLIT}') WHERE rn = 1)
"""


def merge_sides(spark, sf_dir):
    existing, new = orders_split(spark, sf_dir)
    t = D.dedup_lww(existing, "o_custkey", "o_orderdate", ["o_orderkey"])
    s = D.dedup_lww(new, "o_custkey", "o_orderdate", ["o_orderkey"])
    return t, s


@query("merge_into", f"""
WITH {_SIDES}
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       coalesce(s.o_custkey, t.o_custkey) AS o_custkey,
       CASE WHEN s.o_custkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_custkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_custkey IS NOT NULL THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
       CASE WHEN s.o_custkey IS NOT NULL THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority
FROM t FULL OUTER JOIN s ON t.o_custkey = s.o_custkey
""")
def q_merge_into(spark, sf_dir):
    t, s = merge_sides(spark, sf_dir)
    return M.merge_into(t, s, "o_custkey")


@query("merge_actions", f"""
WITH {_SIDES},
  j AS (SELECT t.o_custkey IS NOT NULL AS in_t, s.o_custkey IS NOT NULL AS in_s
        FROM t FULL OUTER JOIN s ON t.o_custkey = s.o_custkey)
SELECT count_if(in_t) AS target_rows_before, count_if(in_s) AS source_rows,
       count_if(in_t AND in_s) AS rows_updated, CAST(0 AS BIGINT) AS rows_skipped,
       count_if(in_s AND NOT in_t) AS rows_inserted, count_if(in_t AND NOT in_s) AS rows_untouched,
       count(*) AS target_rows_after, TRUE AS valid
FROM j
""")
def q_merge_actions(spark, sf_dir):
    t, s = merge_sides(spark, sf_dir)
    return M.merge_actions(t, s, "o_custkey")


_PARITY_SIDES = """
  t AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
          ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) rn FROM orders WHERE o_orderkey % 2 = 1) WHERE rn = 1),
  s AS (SELECT * EXCLUDE (rn, o_orderpriority), 'merge' AS channel FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
          ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) rn FROM orders WHERE o_orderkey % 2 = 0) WHERE rn = 1)"""


def parity_sides(spark, sf_dir):
    """Each customer's latest odd order (target) and latest even one (source, without a priority
    and with a channel): older and newer, matched and not."""
    o = table(spark, sf_dir, "orders")
    latest = lambda df: D.dedup_lww(df, "o_custkey", "o_orderdate", ["o_orderkey"])
    s = latest(o.filter(F.col("o_orderkey") % 2 == 0)).drop("o_orderpriority").withColumn("channel", F.lit("merge"))
    return latest(o.filter(F.col("o_orderkey") % 2 == 1)), s


@query("merge_newer", f"""
WITH {_PARITY_SIDES}
SELECT coalesce(t.o_custkey, s.o_custkey) AS o_custkey,
       CASE WHEN u THEN s.o_orderkey ELSE t.o_orderkey END AS o_orderkey,
       CASE WHEN u THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN u THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN u THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
       t.o_orderpriority, CASE WHEN u THEN s.channel END AS channel
FROM (SELECT t, s, s.o_custkey IS NOT NULL AND (t.o_custkey IS NULL OR s.o_orderdate >= t.o_orderdate) AS u
      FROM t FULL OUTER JOIN s ON t.o_custkey = s.o_custkey)
""")
def q_merge_newer(spark, sf_dir):
    t, s = parity_sides(spark, sf_dir)
    return M.merge_into(t, s, "o_custkey", newer_col="o_orderdate")


@query("merge_newer_actions", f"""
WITH {_PARITY_SIDES},
  j AS (SELECT t.o_custkey IS NOT NULL AS in_t, s.o_custkey IS NOT NULL AS in_s, s.o_orderdate >= t.o_orderdate AS newer
        FROM t FULL OUTER JOIN s ON t.o_custkey = s.o_custkey)
SELECT (SELECT count(*) FROM t) AS target_rows_before, (SELECT count(*) FROM s) AS source_rows,
       count_if(in_t AND in_s AND newer) AS rows_updated, count_if(in_t AND in_s AND NOT newer) AS rows_skipped,
       count_if(in_s AND NOT in_t) AS rows_inserted, count_if(in_t AND NOT in_s) AS rows_untouched,
       count(*) AS target_rows_after, count_if(in_t) = (SELECT count(*) FROM t) AS valid
FROM j
""")
def q_merge_newer_actions(spark, sf_dir):
    t, s = parity_sides(spark, sf_dir)
    return M.merge_actions(t, s, "o_custkey", newer_col="o_orderdate")


@query("update_where", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_totalprice > 300000 AND o_orderstatus = 'O' THEN '1-URGENT'
            ELSE o_orderpriority END AS o_orderpriority
FROM orders
""")
def q_update_where(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    pred = (F.col("o_totalprice") > 300000) & (F.col("o_orderstatus") == "O")
    return M.update_where(o, pred, {"o_orderpriority": F.lit("1-URGENT")})


@query("delete_where", """
SELECT * FROM customer WHERE NOT coalesce(c_acctbal < 0 AND c_mktsegment = 'BUILDING', FALSE)
""")
def q_delete_where(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return M.delete_where(c, (F.col("c_acctbal") < 0) & (F.col("c_mktsegment") == "BUILDING"))


@query("incremental_extract", f"""
SELECT * FROM (SELECT *, rank() OVER (ORDER BY o_orderdate) AS rk FROM orders
               WHERE o_orderdate > TIMESTAMP '{INCREMENT_MARK}') WHERE rk <= {INCREMENT_CAP}
""".replace("SELECT * FROM (SELECT *", "SELECT * EXCLUDE (rk) FROM (SELECT *"))
def q_incremental_extract(spark, sf_dir):
    return I.incremental_extract(table(spark, sf_dir, "orders"), "o_orderdate", INCREMENT_MARK,
                                 INCREMENT_CAP)


@query("incremental_extract_exact", f"""
SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{INCREMENT_MARK}'
ORDER BY o_orderdate, o_orderkey LIMIT {INCREMENT_CAP}
""")
def q_incremental_extract_exact(spark, sf_dir):
    return I.incremental_extract(table(spark, sf_dir, "orders"), "o_orderdate", INCREMENT_MARK,
                                 INCREMENT_CAP, exact=True, tie_cols=["o_orderkey"])


@query("advance_mark", f"""
SELECT count(*) AS rows_extracted, coalesce(max(o_orderdate), TIMESTAMP '{INCREMENT_MARK}') AS new_mark
FROM (SELECT o_orderdate, rank() OVER (ORDER BY o_orderdate) AS rk FROM orders
      WHERE o_orderdate > TIMESTAMP '{INCREMENT_MARK}') WHERE rk <= {INCREMENT_CAP}
""")
def q_advance_mark(spark, sf_dir):
    inc = I.incremental_extract(table(spark, sf_dir, "orders"), "o_orderdate", INCREMENT_MARK,
                                INCREMENT_CAP)
    return I.advance_mark(inc, "o_orderdate", INCREMENT_MARK)


@query("mark_round_trip", f"""
SELECT max(o_orderdate) AS mark FROM (SELECT o_orderdate, rank() OVER (ORDER BY o_orderdate) AS rk FROM orders
      WHERE o_orderdate > TIMESTAMP '{INCREMENT_MARK}') WHERE rk <= {INCREMENT_CAP}
""")
def q_mark_round_trip(spark, sf_dir):
    """The mark after one increment, written to the store and read back."""
    store = shared_dir(spark, "marks")
    new = q_advance_mark(spark, sf_dir).first()["new_mark"]
    I.write_mark(spark, store, "orders", new)
    return spark.range(1).select(I.ts_literal(I.read_mark(spark, store, "orders"), T.TimestampNTZType()).alias("mark"))


def _rewritten_pending(o):
    return o.filter(F.col("o_orderstatus") == "P").withColumn(
        "o_totalprice", F.col("o_totalprice") + 100.0)


_PENDING_SQL = """SELECT o_orderkey, o_custkey, o_totalprice + 100.0 AS o_totalprice, o_orderdate,
       o_orderpriority, o_orderstatus FROM orders WHERE o_orderstatus = 'P'"""


@query("overwrite_static", _PENDING_SQL)
def q_overwrite_static(spark, sf_dir):
    """Base table partitioned by status, then a static INSERT OVERWRITE of the pending rows."""
    o = table(spark, sf_dir, "orders")
    path = shared_dir(spark, "overwrite_static")
    K.overwrite_static(o, path, ["o_orderstatus"])
    K.overwrite_static(_rewritten_pending(o), path, ["o_orderstatus"])
    return spark.read.schema(o.schema).parquet(path)


@query("overwrite_partitions", f"""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus
FROM orders WHERE o_orderstatus IS DISTINCT FROM 'P'
UNION ALL {_PENDING_SQL}
""")
def q_overwrite_partitions(spark, sf_dir):
    """Same, but dynamic: only the pending partition is replaced."""
    o = table(spark, sf_dir, "orders")
    path = shared_dir(spark, "overwrite_dynamic")
    K.overwrite_static(o, path, ["o_orderstatus"])
    K.overwrite_partitions(_rewritten_pending(o), path, ["o_orderstatus"])
    return spark.read.schema(o.schema).parquet(path)


@query("scan_parquet", "SELECT * FROM events")
def q_scan_parquet(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return K.scan_parquet(spark, os.path.join(sf_dir, "events.parquet"), ev.schema)


@query("write_batch", "SELECT * FROM events")
def q_write_batch(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    path = K.write_batch(ev, shared_dir(spark, "batches"), "20240101_000000_000000",
                         partition_by=["event_type"])
    return spark.read.schema(ev.schema).parquet(path)


@query("append_rows", "SELECT * FROM events")
def q_append_rows(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    path = shared_dir(spark, "append")
    K.append_rows(ev.filter(F.col("event_type") == "click"), path)
    K.append_rows(ev.filter(F.col("event_type") != "click").select(*reversed(ev.columns)), path)
    return spark.read.schema(ev.schema).parquet(path)


@query("dedup_and_write", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                            ORDER BY ts DESC NULLS LAST, event_id) rn FROM events) WHERE rn = 1
""")
def q_dedup_and_write(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    path = D.dedup_and_write(ev, ["user_id", "event_type"], shared_dir(spark, "dedup"), "ts",
                             order_by=["event_id"], batch_id="20240101_000000_000000")
    return spark.read.schema(ev.schema).parquet(path)


@query("write_landing", "SELECT *, CAST(CAST(ts AS DATE) AS VARCHAR) AS ingest_date FROM events")
def q_write_landing(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    path = K.write_landing(ev, shared_dir(spark, "landing"), "events",
                           F.date_format("ts", "yyyy-MM-dd"))
    schema = ev.schema.add("ingest_date", "string")
    return spark.read.schema(schema).parquet(path)


@query("validate_landing", "SELECT count(*) AS rows, TRUE AS exists FROM events")
def q_validate_landing(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    path = K.write_landing(ev, shared_dir(spark, "landing"), "events", "2024-01-31")
    return K.validate_landing(spark, path).drop("path")


@query("write_csv", """
SELECT event_type, count(value) AS n_values, round(coalesce(sum(value), 0.0), 6) AS sum_value,
       round(avg(value), 6) AS mean_value
FROM events WHERE event_type IS NOT NULL GROUP BY event_type
""")
def q_write_csv(spark, sf_dir):
    """The group summary as CSV, read back."""
    summary = S.group_summary(table(spark, sf_dir, "events"), "event_type", "value")
    path = K.write_csv(summary, shared_dir(spark, "csv"))
    return spark.read.schema(summary.schema).options(**K.TEXT_OPTIONS).option("header", True).csv(path)


@query("write_jsonl", "SELECT * FROM events")
def q_write_jsonl(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    path = K.write_jsonl(ev, shared_dir(spark, "jsonl"))
    return spark.read.schema(ev.schema).options(**K.TEXT_OPTIONS).json(path)


@query("reconcile_counts", """
SELECT 'whole' AS handoff, count(*) AS expected_rows, count(*) AS actual_rows, TRUE AS match FROM events
UNION ALL SELECT 'short', count(*), count_if(event_type <> 'click'), count(*) = count_if(event_type <> 'click') FROM events
""")
def q_reconcile_counts(spark, sf_dir):
    """Producer writes and declares a count; two consumers re-read and compare, one of them short of rows."""
    ev = table(spark, sf_dir, "events")
    path = K.write_batch(ev, shared_dir(spark, "handoff"), "20240101_000000_000000")
    declared = K.manifest(spark, path, schema=ev.schema).select(F.col("rows").alias("n"))
    got = spark.read.schema(ev.schema).parquet(path)
    side = lambda name, df: S.reconcile_counts(declared, df).select(F.lit(name).alias("handoff"), "*")
    return side("whole", got).unionByName(side("short", got.filter(F.col("event_type") != "click")))
