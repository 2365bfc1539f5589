"""Shards of near-equal bytes by histogram sort (operator 11), DataFrame functions only.

Every row has a long sort key. The weight below candidate boundaries (probes) is counted exactly
over all rows; a splitter whose count is within the tolerance of its target is settled, and the
interval that holds an open one is probed more finely in the next round, until all are settled or
lie between two neighbouring keys. The rows are then numbered behind one exchange by interval.

The key of a document is the hash of its text (38 bits) followed by a hash of its row (24 bits):
equal texts are neighbours and share a shard unless a splitter falls among them, and a text that
holds a third of all rows can still be cut anywhere.

Scale: the rounds read a narrow table (key, size, checksum) that is written once. A round brings
one row per filled bucket to the driver, at most ``PROBES`` or 16 per open interval. Probes halve
an interval several times a round and skip what holds no rows, so the rounds grow with the
logarithm of the rows. Shards are cut by bytes, the intervals inside them by rows (as many as there
are shuffle partitions), so no task numbers a whole shard or a whole group of copies.

Defined results: null text has no bytes and the checksum 0, and its size is 1; null ids and
repeated rows are rows like any other; a text longer than a shard makes that shard larger; with
fewer rows than shards some shards are empty; an empty table gives an empty result. Very long texts
are hashed where they are read and never moved by ``op11_sharding``. ``shard_rows`` keeps all
columns of its input and raises where one bears the name of a column it adds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.fingerprints import range_of
from tidewater.llm.scratch import Scratch, with_row_numbers
from tidewater.tables import table

SHARDS = 8
TOLERANCE = 0.001
PROBES = 4096
TEXT_BITS, ROW_BITS = 38, 24
ADDED = ("shard_key", "shard_row", "shard_interval", "shard", "slot")


@dataclass
class Span:
    """Keys from ``low`` to ``high``: the weight ``below`` them and the targets that fall among them."""

    low: int
    high: int
    below: int
    targets: list[float]


def _top_bits(value: Column, bits: int) -> Column:
    return F.shiftrightunsigned(value, 64 - bits)


def text_key(text: Column, row: Column) -> Column:
    """62-bit sort key: equal texts are neighbours, and the rows of one text are told apart."""
    high = F.shiftleft(_top_bits(F.xxhash64(text), TEXT_BITS), ROW_BITS)
    return high.bitwiseOR(_top_bits(F.xxhash64(F.lit("row"), row), ROW_BITS))


def _pick(values: Sequence[int]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.col("span"))


def _histogram(rows: DataFrame, spans: list[Span], buckets: int) -> dict[int, list[tuple[int, int, int]]]:
    """Per span: (weight, lowest key, highest key) of its filled buckets, in key order.

    Buckets begin at multiples of a power of two, so their number is found by shifts.
    """
    # a span of at most 2^b keys touches at most ``buckets`` multiples of 2^shift
    shifts = [max(0, (s.high - s.low).bit_length() - buckets.bit_length() + 2) for s in spans]
    at = range_of(F.col("key"), [s.low for s in spans])
    inside = rows.withColumn("span", at).where((F.col("key") >= spans[0].low) & (F.col("key") <= _pick([s.high for s in spans])))
    bucket = F.call_function("shiftright", F.col("key"), _pick(shifts))
    counts = inside.groupBy("span", bucket.alias("bucket")).agg(
        F.sum("weight").alias("weight"), F.min("key").alias("low"), F.max("key").alias("high"))
    out: dict[int, list[tuple[int, int, int]]] = {}
    for r in sorted(counts.collect(), key=lambda r: (r["span"], r["low"])):  # bounded by the probes
        out.setdefault(r["span"], []).append((r["weight"], r["low"], r["high"]))
    return out


def splitters(rows: DataFrame, parts: int, tolerance: float = TOLERANCE, probes: int = PROBES) -> list[int]:
    """Lowest keys of the parts after the first, for ``rows`` of (key, weight), both non-null longs.

    A splitter's weight below is within ``tolerance`` of a part's ideal weight from its target, or
    no other boundary between two different keys is nearer to it. Rows of one key stay together.
    """
    first = rows.agg(F.sum("weight").alias("w"), F.min("key").alias("low"), F.max("key").alias("high")).first()
    if first["w"] is None:
        return []
    total, slack = int(first["w"]), tolerance * first["w"] / parts
    open_spans = [Span(first["low"], first["high"], 0, [total * k / parts for k in range(1, parts)])]
    found: list[int] = []
    while open_spans:
        probed = _histogram(rows, open_spans, max(16, probes // len(open_spans)))
        following = []
        for k, span in enumerate(open_spans):
            before, filled = span.below, probed[k]
            todo = list(span.targets)
            for i, (weight, low, high) in enumerate(filled):
                after = before + weight
                last = i + 1 == len(filled)
                mine = [t for t in todo if t <= after or last]
                todo = todo[len(mine):]
                inner = []
                for t in mine:
                    nearer = before if t - before <= after - t else after
                    if low == high or abs(t - nearer) <= slack:
                        found.append(low if nearer == before else high + 1)
                    else:
                        inner.append(t)
                if inner:
                    following.append(Span(low, high, before, inner))
                before = after
        open_spans = following
    return sorted(found)


def shard_rows(rows: DataFrame, shards: int = SHARDS, text_col: str = "text", size_col: str = "size",
               tolerance: float = TOLERANCE, intervals: int | None = None) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1) and ``slot``, the place in the shard from 0.

    ``size_col`` is a positive weight; the shards' sums are near equal. ``shard_key`` (the sort key)
    and ``shard_row`` (a unique number) order the rows of a shard. ``text_col`` may hold the text or
    anything that is equal for equal texts. The rows are written once to the shared folder.
    """
    clash = sorted({c.lower() for c in rows.columns} & set(ADDED))
    if clash:
        raise ValueError(f"columns {clash} would be overwritten")
    spark = rows.sparkSession
    scratch = Scratch(spark, "sharding")
    numbered = with_row_numbers(rows, scratch, "rows", "shard_row")
    keyed = numbered.withColumn("shard_key", text_key(F.col(text_col), F.col("shard_row")))
    key = F.col("shard_key").alias("key")
    borders = splitters(keyed.select(key, F.col(size_col).cast("long").alias("weight")), shards, tolerance)
    # inside the shards, rows are numbered in intervals of near-equal row counts
    cuts = splitters(keyed.select(key, F.lit(1).cast("long").alias("weight")),
                     intervals or int(spark.conf.get("spark.sql.shuffle.partitions")), 0.1)
    lows = sorted({-1, *borders, *cuts})
    placed = keyed.withColumn("shard_interval", range_of(F.col("shard_key"), lows))
    counts = {r["shard_interval"]: r["count"] for r in placed.groupBy("shard_interval").count().collect()}  # one row an interval
    shard_of, start, filled = [], [], {}
    for i, low in enumerate(lows):
        s = sum(b <= low for b in borders)
        shard_of.append(s)
        start.append(filled.get(s, 0))
        filled[s] = start[-1] + counts.get(i, 0)
    at = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("shard_interval"))
    place = F.row_number().over(Window.partitionBy("shard_interval").orderBy("shard_key", "shard_row")) - 1
    return placed.select(*numbered.columns, "shard_key", at(shard_of).cast("int").alias("shard"),
                         (at(start) + place).cast("long").alias("slot"))


def document_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, text_hash): what sharding needs of a document, without its text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
                       F.xxhash64(F.col(text_col)).alias("text_hash"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = document_sizes(table(spark, sf_dir, "documents"))
    return shard_rows(sized, SHARDS, "text_hash").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
