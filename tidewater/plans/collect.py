"""Collector queries over envelopes built from ``events`` (100 items per page, 5 repeated; of
every 50 pages one is empty and one failed; items with value < 1 lack an id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.plans.registry import query
from tidewater.sources import collector as CO
from tidewater.tables import table


def cursor_token(page: Column) -> Column:
    """Opaque cursor used by the envelope builder (any unique string works)."""
    return F.md5(F.concat(F.lit("c"), page.cast("string")))


def build_envelopes(events: DataFrame, page_size: int = 100, overlap: int = 5,
                    failed: Column | None = None, empty: Column | None = None,
                    missing_id: Column | None = None) -> DataFrame:
    """Envelopes as an API would return them for ``events`` ordered by ``event_id``.

    Page p holds ids ``[(p-1)*size - overlap, p*size)`` (the last ``overlap`` items of a page
    repeat on the next); pages where ``failed`` holds have no data, pages where ``empty`` holds
    an empty list; items matching ``missing_id`` carry a NULL id. Each page is built by one
    bounded group (``page_size + overlap`` rows).
    """
    missing_id = missing_id if missing_id is not None else F.col("value") < 1.0
    failed = failed if failed is not None else F.col("page") % 50 == 7
    empty = empty if empty is not None else F.col("page") % 50 == 5
    page0 = (F.floor(F.col("event_id") / page_size) + 1).cast("int")
    item = F.struct(
        F.when(missing_id, F.lit(None)).otherwise(F.col("event_id").cast("string")).alias("id"),
        "user_id", "event_type", "value", "ts")
    base = events.select("event_id", page0.alias("page0"), item.alias("item"))
    copies = base.select(
        F.explode(F.when((F.col("event_id") % page_size) >= page_size - overlap,
                         F.array(F.col("page0"), F.col("page0") + 1))
                  .otherwise(F.array(F.col("page0")))).alias("page"),
        "event_id", "item")
    pages = copies.groupBy("page").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("event_id", "item"))),
                    lambda s: s["item"]).alias("data"))
    last = pages.select(F.max("page")).scalar()
    has_next = (F.col("page") < last) & ~failed
    return pages.select(
        F.col("page").cast("int").alias("page"),
        F.when(failed, "failed").otherwise("ok").alias("status"),
        F.when(failed, F.lit(None)).when(empty, F.array().cast(T.ArrayType(CO.ITEM_SCHEMA)))
        .otherwise(F.col("data")).alias("data"),
        F.when(has_next, (F.col("page") + 1).cast("string")).alias("next_page"),
        F.when(has_next, cursor_token(F.col("page") + 1)).alias("next_cursor"),
        F.when(F.col("page") > 1, cursor_token(F.col("page"))).alias("request_cursor"),
    )


ENV_SQL = """
ev AS (SELECT event_id, CAST(floor(event_id / 100) AS INTEGER) + 1 AS page0,
              CASE WHEN value < 1.0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS id,
              user_id, event_type, value, ts FROM events),
copies AS (SELECT page0 AS page, * EXCLUDE (page0) FROM ev
           UNION ALL SELECT page0 + 1 AS page, * EXCLUDE (page0) FROM ev WHERE event_id % 100 >= 95),
items AS (SELECT *, CAST(row_number() OVER (PARTITION BY page ORDER BY event_id) - 1 AS INTEGER) AS pos
          FROM copies),
landed AS (SELECT * FROM items WHERE page % 50 NOT IN (5, 7))"""


def envelopes(spark, sf_dir):
    return build_envelopes(table(spark, sf_dir, "events"))


@query("collect_pages", f"""WITH {ENV_SQL}
SELECT id, page, pos, user_id, event_type, value, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY page, pos) AS rn FROM landed
  WHERE id IS NOT NULL AND id <> '') WHERE rn = 1""")
def q_collect_pages(spark, sf_dir):
    return CO.collect_pages(envelopes(spark, sf_dir))


@query("collect_dropped", f"WITH {ENV_SQL} SELECT count(*) AS dropped_no_id FROM landed WHERE id IS NULL OR id = ''")
def q_collect_dropped(spark, sf_dir):
    """Items dropped for lack of an id (counted instead of lost)."""
    return CO.dropped_items(envelopes(spark, sf_dir))


@query("landing_stats", f"""WITH {ENV_SQL},
p AS (SELECT page, CASE WHEN page % 50 = 7 THEN 'failed' ELSE 'ok' END AS status,
             CASE WHEN page % 50 IN (5, 7) THEN 0 ELSE count(*) END AS n FROM copies GROUP BY page)
SELECT status, count(*) AS pages, count_if(n = 0) AS empty_pages, CAST(sum(n) AS BIGINT) AS items FROM p GROUP BY status""")
def q_landing_stats(spark, sf_dir):
    return CO.landing_stats(envelopes(spark, sf_dir))
