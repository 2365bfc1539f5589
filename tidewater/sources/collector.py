"""Paginated API collection as Spark jobs over *landed* response envelopes.

Fetching is outside Spark (network client); every response lands as one envelope row
``(page, status, data array<struct>, next_page, next_cursor, request_cursor)``. Every landed page
was fetched, so collection is a plan over all of them, in whatever order and however often they
landed: explode the items, drop (and count) those without an id, keep the first-seen copy per id.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ITEM_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("ts", T.TimestampNTZType()),
])

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("page", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("data", T.ArrayType(ITEM_SCHEMA)),
    T.StructField("next_page", T.StringType()),
    T.StructField("next_cursor", T.StringType()),
    T.StructField("request_cursor", T.StringType()),
])


def read_envelopes(spark, path: str, fmt: str = "json") -> DataFrame:
    """Landed envelopes with an explicit schema (no inference over raw responses); of malformed ones
    only what can be read. ``read_landing`` tells them apart."""
    return spark.read.schema(ENVELOPE_SCHEMA).format(fmt).load(path)


STATUSES = ("ok", "failed")
_BAD = "_malformed"


def parse_envelopes(lines: DataFrame, value: str = "value", schema: T.StructType = ENVELOPE_SCHEMA,
                    options: dict[str, str] | None = None) -> DataFrame:
    """``lines`` with ``envelope`` (a struct) and ``reason``, null for envelopes that can be collected.

    Rejected are lines that are no JSON object of the schema ('malformed'), that have no page
    ('no page'), no known status ('unknown status'), or are ok but have no list of items ('no items').
    A plan over one row at a time: it is the same for tables and streams.
    """
    whole = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    read = F.from_json(F.col(value), whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD, **(options or {})})
    e = F.col("_read")
    reason = (F.when(e.isNull() | e[_BAD].isNotNull(), "malformed").when(e["page"].isNull(), "no page")
              .when(~F.coalesce(e["status"].isin(*STATUSES), F.lit(False)), "unknown status")
              .when((e["status"] == "ok") & e["data"].isNull(), "no items"))
    envelope = F.struct(*[e[f.name].alias(f.name) for f in schema.fields])
    return lines.withColumn("_read", read).select(*lines.columns, envelope.alias("envelope"), reason.alias("reason"))


def landed_lines(lines: DataFrame) -> DataFrame:
    """Text lines with the file that they are from; empty lines are none."""
    return lines.select("value", F.col("_metadata.file_path").alias("file")).where(F.trim("value") != "")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).select("envelope.*")


def rejected(parsed: DataFrame) -> DataFrame:
    """(file, reason, line): every rejected line as it landed."""
    return parsed.where(F.col("reason").isNotNull()).select("file", "reason", F.col("value").alias("line"))


def read_landing(spark, path: str, schema: T.StructType = ENVELOPE_SCHEMA, options: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted envelopes, rejects) of landed JSON Lines: together, every line once."""
    parsed = parse_envelopes(landed_lines(spark.read.text(path)), "value", schema, options)
    return accepted(parsed), rejected(parsed)


def default_item_id(item: Column, fields: Sequence[str] = ("id",)) -> Column:
    """Id rule: the ``id`` field; only when items have no ``id`` field at all, ``order_id``.
    Items whose id is NULL or empty are dropped (and counted)."""
    if "id" in fields:
        return item["id"].cast("string")
    if "order_id" in fields:
        return item["order_id"].cast("string")
    return F.lit(None).cast("string")


def landed_items(env: DataFrame, item_id: Callable[[Column], Column] | None = None,
                 items: Column | None = None) -> DataFrame:
    """(page, pos, id, item) of every landed page. ``items`` is the expression that finds the
    items in an envelope (default: ``data``), ``item_id`` the rule that names one."""
    listed = env.select("page", F.posexplode(items if items is not None else F.col("data")).alias("pos", "item"))
    fields = [f.name for f in listed.schema["item"].dataType.fields]
    rule = item_id if item_id is not None else (lambda c: default_item_id(c, fields))
    return listed.select("page", "pos", rule(F.col("item")).alias("id"), "item")


def _named(id_col: Column) -> Column:
    return id_col.isNotNull() & (id_col != "")


def first_seen(items: DataFrame) -> DataFrame:
    """The first copy of every id in (page, position) order; items without an id are dropped."""
    w = Window.partitionBy("id").orderBy("page", "pos")
    keep = (items.filter(_named(F.col("id")))
            .withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn"))
    fields = [f.name for f in keep.schema["item"].dataType.fields if f.name != "id"]
    return keep.select("id", "page", "pos", *[F.col("item")[f].alias(f) for f in fields])


def collect_pages(env: DataFrame, item_id: Callable[[Column], Column] | None = None,
                  items: Column | None = None) -> DataFrame:
    """Every first-seen item of all landed pages."""
    return first_seen(landed_items(env, item_id, items))


def dropped_items(env: DataFrame, item_id: Callable[[Column], Column] | None = None,
                  items: Column | None = None) -> DataFrame:
    """Distinct landed places (page, position) whose item was dropped for lack of an id."""
    nameless = landed_items(env, item_id, items).filter(~F.coalesce(_named(F.col("id")), F.lit(False)))
    return nameless.select("page", "pos").distinct().agg(F.count(F.lit(1)).alias("dropped_no_id"))


def landing_stats(env: DataFrame) -> DataFrame:
    """Per status: landed pages (each counted once), empty ones and items on them."""
    size = F.greatest(F.coalesce(F.size("data"), F.lit(0)), F.lit(0))
    pages = env.groupBy("status", "page").agg(F.max(size).alias("n"))
    return pages.groupBy("status").agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.col("n") == 0).alias("empty_pages"),
                                       F.sum("n").alias("items"))
