"""Streaming queries: each runs a Structured Streaming job to completion (availableNow)
over files landed from the driver tables, then reads the sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.plans.collect import ENV_SQL, build_envelopes
from tidewater.plans.dml import INCREMENT_MARK
from tidewater.plans.registry import query
from tidewater.session import materialize, shared_dir
from tidewater.sources import collector as CO
from tidewater.sources.sinks import TEXT_OPTIONS
from tidewater.streaming import jobs as J
from tidewater.tables import table


@query("stream_collect", f"""WITH {ENV_SQL}
SELECT DISTINCT id, user_id, event_type, value, ts FROM landed WHERE id IS NOT NULL AND id <> ''""")
def q_stream_collect(spark, sf_dir):
    env = build_envelopes(table(spark, sf_dir, "events"))
    landing = shared_dir(spark, "envelopes")
    env.repartition(16, "page").write.options(**TEXT_OPTIONS).json(landing)
    return J.stream_collect(spark, landing, shared_dir(spark, "stream_items"), shared_dir(spark, "ckpt"))


@query("stream_increment", f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{INCREMENT_MARK}'")
def q_stream_increment(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    landing = shared_dir(spark, "orders_landing")
    orders.repartition(8).write.parquet(landing)
    return J.stream_increment(spark, landing, orders.schema, shared_dir(spark, "increment"),
                              shared_dir(spark, "ckpt"), "o_orderdate", INCREMENT_MARK)


@query("stream_upsert", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                            ORDER BY ts DESC NULLS LAST, event_id) rn FROM events) WHERE rn = 1""")
def q_stream_upsert(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    landing = shared_dir(spark, "events_landing")
    ev.repartition(6, F.to_date("ts")).write.parquet(landing)
    return J.stream_upsert(spark, landing, ev.schema, shared_dir(spark, "upsert_target"),
                           shared_dir(spark, "ckpt"), ["user_id"], "ts", ["event_id"], files_per_trigger=2)


def _landed_in_order(spark, sf_dir, landings: int = 8) -> str:
    """Envelopes landed in fetch order, in ``landings`` appends of two files."""
    env = materialize(build_envelopes(table(spark, sf_dir, "events")), "envelopes")
    path = shared_dir(spark, "landing")
    last = env.select(F.max("page")).first()[0]
    step = max(1, -(-last // landings))
    for lo in range(1, last + 1, step):
        (env.filter((F.col("page") >= lo) & (F.col("page") < lo + step)).repartition(2, "page")
         .write.mode("append").options(**TEXT_OPTIONS).json(path))
    return path


@query("stream_collect_bounded", f"""WITH {ENV_SQL}
SELECT DISTINCT id, user_id, event_type, value, ts FROM landed WHERE id IS NOT NULL AND id <> ''""")
def q_stream_collect_bounded(spark, sf_dir):
    """Same stream with dedup state bounded by an event-time watermark."""
    landing = _landed_in_order(spark, sf_dir)
    return J.stream_collect(spark, landing, shared_dir(spark, "stream_items"), shared_dir(spark, "ckpt"),
                            watermark="1 day", files_per_trigger=2)


LATE_BEFORE = "2024-01-15"
# Files of a landing at most: written side by side, and all of them in one micro-batch.
LANDING_FILES = 48


@query("stream_first_and_late", f"""WITH {ENV_SQL},
named AS (SELECT id, user_id, event_type, value, ts FROM landed WHERE id IS NOT NULL AND id <> '')
SELECT DISTINCT *, 'first' AS tag FROM named WHERE ts >= TIMESTAMP '{LATE_BEFORE}'
UNION ALL SELECT *, 'late' FROM named WHERE ts < TIMESTAMP '{LATE_BEFORE}'""")
def q_stream_first_and_late(spark, sf_dir):
    """Newer items land first; the query is restarted when the older ones have landed, which are all late."""
    env = materialize(build_envelopes(table(spark, sf_dir, "events")), "envelopes")
    landing, how = shared_dir(spark, "landing"), (shared_dir(spark, "tagged"), shared_dir(spark, "ckpt"), "0 seconds", 86400, 100)
    newer = lambda i: i["ts"] >= F.lit(LATE_BEFORE).cast("timestamp_ntz")
    for keep in (newer, lambda i: ~newer(i)):
        part = env.withColumn("data", F.filter("data", keep))
        part.coalesce(LANDING_FILES).write.mode("append").options(**TEXT_OPTIONS).json(landing)
        items = J.stream_first_and_late(spark, landing, *how)[0]
    return items


REJECTS_SQL = f"""WITH {ENV_SQL},
p AS (SELECT DISTINCT page, CASE WHEN page % 10 = 3 THEN 'malformed' WHEN page % 10 = 4 THEN 'no page'
                                 WHEN page % 10 = 6 THEN 'unknown status' END AS reason FROM copies)"""


def spoiled_lines(spark, sf_dir):
    """Envelopes as JSON Lines; of ten pages one is cut short, one has lost its page and one has an odd status."""
    env = build_envelopes(table(spark, sf_dir, "events"))
    digit = F.col("page") % 10
    whole = F.to_json(F.struct(F.when(digit != 4, F.col("page")).alias("page"), F.when(digit == 6, "teapot").otherwise(F.col("status")).alias("status"),
                               *[c for c in env.columns if c not in ("page", "status")]), TEXT_OPTIONS)
    line = F.when(digit == 3, F.expr("substring(line, 1, 20)")).otherwise(F.col("line"))
    path = shared_dir(spark, "spoiled")
    env.select("page", whole.alias("line")).select(line.alias("value")).repartition(6).write.text(path)
    return path


@query("landing_rejects", f"""{REJECTS_SQL}
SELECT coalesce(reason, 'accepted') AS outcome, count(*) AS lines FROM p GROUP BY ALL""")
def q_landing_rejects(spark, sf_dir):
    """Lines by outcome: accepted envelopes and rejects of a batch read."""
    good, bad = CO.read_landing(spark, spoiled_lines(spark, sf_dir), options=TEXT_OPTIONS)
    outcomes = good.select(F.lit("accepted").alias("outcome")).unionByName(bad.select(F.col("reason").alias("outcome")))
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("lines"))


@query("stream_landing", f"""{REJECTS_SQL}
SELECT count(*) AS landed, count(*) FILTER (reason IS NULL) AS accepted, count(reason) AS rejected,
       count(*) FILTER (reason IS NULL) AS accepted_rows, count(reason) AS rejected_rows FROM p""")
def q_stream_landing(spark, sf_dir):
    """The same as a stream: the micro-batches' own counts, and the rows that they wrote."""
    good, bad, counts = J.stream_landing(spark, spoiled_lines(spark, sf_dir), shared_dir(spark, "landed"), shared_dir(spark, "ckpt"), 2)
    return counts.agg(*[F.sum(c).alias(c) for c in ("landed", "accepted", "rejected")]).select(
        "*", good.agg(F.count(F.lit(1))).scalar().alias("accepted_rows"), bad.agg(F.count(F.lit(1))).scalar().alias("rejected_rows"))
