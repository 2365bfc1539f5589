"""Dedup, upsert and summary queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import dedup as D
from tidewater.operators import summary as S
from tidewater.plans.registry import query
from tidewater.tables import table

LINEITEM_KEYS = ["l_orderkey", "l_linenumber"]
LINEITEM_TIES = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
UPSERT_SPLIT = "1998-01-01"


def lineitem_lww(spark, sf_dir):
    return D.dedup_lww(table(spark, sf_dir, "lineitem"), LINEITEM_KEYS, "l_shipdate", LINEITEM_TIES)


_LW_SQL = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn
  FROM lineitem) WHERE rn = 1
"""


@query("dedup_lww", _LW_SQL)
def q_dedup_lww(spark, sf_dir):
    return lineitem_lww(spark, sf_dir)


@query("dedup_fww", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate NULLS LAST, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn
  FROM lineitem) WHERE rn = 1
""")
def q_dedup_fww(spark, sf_dir):
    # input order = ship date, then the tie columns
    return D.dedup_fww(table(spark, sf_dir, "lineitem"), LINEITEM_KEYS, ["l_shipdate", *LINEITEM_TIES])


@query("dedup_fww_input_order", """
SELECT * EXCLUDE (rn, pos) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY pos) AS rn
  FROM (SELECT *, row_number() OVER () AS pos FROM lineitem)) WHERE rn = 1
""")
def q_dedup_fww_input_order(spark, sf_dir):
    """First write wins in the order of the input itself: file, then row within the file."""
    return D.dedup_fww(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"],
                       [F.col("_metadata.file_path"), F.col("_metadata.row_index")])


@query("dedup_summary", f"""
SELECT l_returnflag, l_linestatus,
       count(*) AS n_lines,
       round(sum(l_quantity), 2) AS sum_qty,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
       round(avg(l_discount), 6) AS avg_disc
FROM ({_LW_SQL}) GROUP BY l_returnflag, l_linestatus
""")
def q_dedup_summary(spark, sf_dir):
    """Flagship: last-write-wins dedup of lineitem, then a flag/status summary."""
    return lineitem_lww(spark, sf_dir).groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"),
    )


@query("dedup_stats", """
SELECT count(*) AS input_rows,
       (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS unique_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicate_rows,
       round((count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))) * 100.0
             / count(*), 4)::DOUBLE AS pct_reduction
FROM lineitem
""")
def q_dedup_stats(spark, sf_dir):
    return D.dedup_stats(table(spark, sf_dir, "lineitem"), LINEITEM_KEYS)


@query("null_key_audit", """
SELECT count_if(l_orderkey IS NULL) AS null_l_orderkey,
       count_if(l_linenumber IS NULL) AS null_l_linenumber
FROM lineitem
""")
def q_null_key_audit(spark, sf_dir):
    return D.null_key_audit(table(spark, sf_dir, "lineitem"), LINEITEM_KEYS)


@query("null_key_audit_dirty", """
SELECT count_if(l_linenumber = 7) AS null_l_orderkey, count_if(l_orderkey % 5 = 0) AS null_l_linenumber FROM lineitem
""")
def q_null_key_audit_dirty(spark, sf_dir):
    """The same audit where keys are missing."""
    li = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("l_orderkey"),
        F.when(F.col("l_orderkey") % 5 != 0, F.col("l_linenumber")).alias("l_linenumber"))
    return D.null_key_audit(li, LINEITEM_KEYS)


@query("dedup_batches", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, CAST(ts AS DATE) AS batch_id,
         row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id
                            ORDER BY ts DESC NULLS LAST, event_id) AS rn
  FROM events) WHERE rn = 1
""")
def q_dedup_batches(spark, sf_dir):
    """One job for all daily batches: latest event per user per day."""
    return D.dedup_batches(table(spark, sf_dir, "events"), F.to_date("ts"), "user_id", "ts", ["event_id"])


_UPSERT_SQL = f"""
SELECT * EXCLUDE (rn, side) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
                               ORDER BY o_orderdate DESC NULLS LAST, side, o_orderkey) AS rn
  FROM (SELECT *, 0 AS side FROM orders WHERE o_orderdate < TIMESTAMP '{UPSERT_SPLIT}'
        UNION ALL
        SELECT *, 1 AS side FROM orders WHERE o_orderdate >= TIMESTAMP '{UPSERT_SPLIT}'))
WHERE rn = 1
"""


def orders_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    cut = F.lit(UPSERT_SPLIT).cast("timestamp_ntz")
    return orders.filter(F.col("o_orderdate") < cut), orders.filter(F.col("o_orderdate") >= cut)


@query("upsert_lww", _UPSERT_SQL)
def q_upsert_lww(spark, sf_dir):
    existing, new = orders_split(spark, sf_dir)
    return D.upsert_lww(new, existing, "o_custkey", "o_orderdate", ["o_orderkey"])


@query("group_summary", """
SELECT event_type, count(value) AS n_values,
       round(coalesce(sum(value), 0.0), 6) AS sum_value,
       round(avg(value), 6) AS mean_value
FROM events WHERE event_type IS NOT NULL GROUP BY event_type
""")
def q_group_summary(spark, sf_dir):
    return S.group_summary(table(spark, sf_dir, "events"), "event_type", "value")


META_KEYS = ["user_id", "event_type", "value", "timestamp"]


def event_docs(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return S.event_documents(
        ev, "event_id", "Event %s by user %d with value %.2f", ["event_type", "user_id", "value"],
        {"user_id": F.col("user_id"), "event_type": F.col("event_type"),
         "value": F.format_string("%.2f", F.col("value")), "timestamp": F.date_format("ts", "yyyy-MM-dd HH:mm:ss")})


def flat(docs):
    """The metadata map read back by key (flat columns compare reliably across engines)."""
    return docs.select("id", "text", *[F.col("metadata")[k].alias(f"meta_{k}") for k in META_KEYS])


_EVENT_DOCS_SQL = """
SELECT CAST(event_id AS VARCHAR) AS id,
       printf('Event %s by user %d with value %.2f', event_type, user_id, value) AS text,
       CAST(user_id AS VARCHAR) AS meta_user_id, event_type AS meta_event_type,
       printf('%.2f', value) AS meta_value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS meta_timestamp
FROM events"""


@query("event_documents", _EVENT_DOCS_SQL)
def q_event_documents(spark, sf_dir):
    """Text + metadata documents built from event rows (the vector-store input form)."""
    return flat(event_docs(spark, sf_dir))


@query("keyword_filter", f"SELECT * FROM ({_EVENT_DOCS_SQL}) WHERE contains(text, 'purchase')")
def q_keyword_filter(spark, sf_dir):
    return flat(S.keyword_filter(event_docs(spark, sf_dir), "purchase"))


@query("metadata_filter", f"SELECT * FROM ({_EVENT_DOCS_SQL}) WHERE meta_event_type = 'purchase'")
def q_metadata_filter(spark, sf_dir):
    return flat(S.metadata_filter(event_docs(spark, sf_dir), "event_type", "purchase"))


@query("category_list", "SELECT DISTINCT event_type AS category FROM events WHERE event_type IS NOT NULL")
def q_category_list(spark, sf_dir):
    return S.category_list(table(spark, sf_dir, "events"), "event_type")
