"""Document fingerprints from closed syncmers (operator 9), DataFrame functions only.

A text is cut into units: words, and of runs longer than ``UNIT_CHARS`` (unspaced scripts, base64) the
single characters, so that an edit in a run disturbs only the anchors around it. Every window of
``K`` units is a k-mer; its inner substrings are the ``S``-unit windows inside it. A k-mer is
kept when its smallest inner hash stands first or last: a choice that depends on the k-mer alone,
not on its neighbours, so an edit disturbs only the anchors that overlap it. The fingerprint is
the sorted set of the kept k-mers' 32-bit hashes; ``syncmers`` also gives their positions.

Scale: the texts are hashed where they are read. To meet its next document, a text is shuffled
once, by ranges of doc_id whose bounds come from an id-only job; ``lead`` finds the neighbour
inside a range, and the first row of each range (as many rows as there are ranges) closes the
gaps. Work per text is linear in its length.

Defined results: null text is empty and has an empty fingerprint; a text without a closed syncmer
(each of fewer than ``K`` units, and some up to two units longer) uses its S-unit windows, or its units
if there are fewer than ``S``, so a text with any word has a fingerprint; two empty fingerprints
have likeness 1 and an empty and a filled one 0; equal ids are ordered by text and null ids come
last; a table of one row is its own next document; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.tables import table

K = 5
S = 2
UNIT_CHARS = 24
UNIT = rf"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]{{1,{UNIT_CHARS}}}(?![^\x20\x09-\x0D])|[^\x20\x09-\x0D]"


def unit_hashes(text: Column) -> Column:
    """64-bit hashes of a text's units, in order."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(UNIT), F.lit(0)), lambda u: F.xxhash64(u))


def window_hashes(units: Column, width: int) -> Column:
    """Hashes of all windows of ``width`` units; empty if there are fewer units."""
    last = F.size(units) - width
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(units, i + j) for j in range(width)]))


def syncmer_starts(inner: Column, k: int = K, s: int = S) -> Column:
    """Starts of the closed syncmers, from the hashes of all S-unit windows."""
    span = k - s + 1  # inner windows of a k-mer
    last = F.size(inner) - span
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

    def at_edge(i: Column) -> Column:
        lowest = F.least(*[F.get(inner, i + j) for j in range(span)])
        return F.least(F.get(inner, i), F.get(inner, i + (span - 1))) == lowest

    return F.filter(starts, at_edge)


def syncmers(docs: DataFrame, text_col: str = "text", k: int = K, s: int = S, prefix: str = "") -> DataFrame:
    """``docs`` with ``{prefix}anchors``: the anchors (hash, start) of each text, in text order.

    Each step is a column of its own, so no expression is computed more than once.
    """
    units, inner, starts = f"{prefix}units", f"{prefix}inner", f"{prefix}starts"
    staged = (docs.withColumn(units, unit_hashes(F.col(text_col)))
              .withColumn(inner, window_hashes(F.col(units), s))
              .withColumn(starts, syncmer_starts(F.col(inner), k, s)))
    inside = k // s

    def kmer(i: Column) -> Column:
        # a k-mer is hashed from the disjoint S-unit windows that cover it
        offsets = [j * s for j in range(inside)] + ([k - s] if k % s else [])
        return F.xxhash64(*[F.get(F.col(inner), i + j) for j in offsets])

    anchor = lambda h, i: F.struct(F.shiftright(h, 32).cast("int").alias("hash"), i.cast("int").alias("start"))
    full = F.transform(starts, lambda i: anchor(kmer(i), i))
    windows = F.transform(inner, lambda h, i: anchor(h, i))
    single = F.transform(units, lambda h, i: anchor(h, i))
    short = F.when(F.size(units) >= s, windows).otherwise(single)
    return (staged.withColumn(f"{prefix}anchors", F.when(F.size(starts) > 0, full).otherwise(short))
            .drop(units, inner, starts))


def fingerprint(anchors: Column) -> Column:
    """Sorted distinct anchor hashes; positions are left out, so moved passages still match."""
    return F.array_sort(F.array_distinct(F.transform(anchors, lambda a: a["hash"])))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprints."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - shared
    return F.when(total == 0, F.lit(1.0)).otherwise(shared / total).cast("double")


def range_bounds(ids: DataFrame, parts: int) -> list[tuple[int, int]]:
    """Lowest and highest key of at most ``parts`` ranges of the non-null longs in ``key``.

    Spark samples the ids and deals them by range; two numbers a range come to the driver.
    """
    dealt = ids.where(F.col("key").isNotNull()).repartitionByRange(parts, "key")
    ends = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.min("key").alias("low"), F.max("key").alias("high"))
    return sorted((r["low"], r["high"]) for r in ends.collect())


def range_of(key: Column, lows: list[int]) -> Column:
    """Index of the last of the sorted ``lows`` at or below ``key`` (0 where there is none), by bisection."""
    if len(lows) < 2:
        return F.lit(0)
    steps, step = [], 1 << (len(lows) - 1).bit_length()
    while step:
        steps.append(F.lit(step))
        step >>= 1
    limits = F.array(*[F.lit(low) for low in lows])
    return F.aggregate(F.array(*steps), F.lit(0), lambda at, step: F.when(
        F.coalesce(F.get(limits, at + step) <= key, F.lit(False)), at + step).otherwise(at))


def with_next(docs: DataFrame, prepare, payload: list[str], id_col: str = "doc_id", text_col: str = "text",
              ranges: int | None = None) -> DataFrame:
    """``prepare(docs)`` with ``next_<c>`` for each payload column: that of the next row by descending id.

    After the last row comes the first; null ids stand last. ``prepare`` adds columns row by row.
    """
    ranges = ranges or 3 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.col(id_col).cast("long")
    ids = docs.select(key.alias("key"))
    bounds = range_bounds(ids, ranges)
    last = len(bounds) + (not ids.where(F.col("key").isNull()).isEmpty())
    # ranges count from 1, highest ids first; null ids have the range after all others
    of_row = F.when(key.isNull(), len(bounds) + 1).otherwise(len(bounds) - range_of(key, [low for low, _ in bounds]))
    # the bare rows travel; what prepare adds is computed behind the shuffle, which the window reuses
    dealt = prepare(docs.withColumn("range", of_row).repartition("range"))
    w = Window.partitionBy("range").orderBy(key.desc_nulls_last(), F.col(text_col).desc_nulls_last())
    inside = dealt.withColumn("next", F.lead(F.struct(F.lit(1).alias("there"), *payload)).over(w))
    # the first row of each range, read by its id, follows the last row of the range before
    tops = docs.where(key.isNull() | key.isin([high for _, high in bounds])).withColumn("range", of_row)
    first = tops.groupBy("range").agg(F.max(F.struct(text_col)).alias("top")).select("range", "top.*")
    heads = prepare(first).select(
        F.when(F.col("range") == 1 if bounds else F.lit(True), last).otherwise(F.col("range") - 1).alias("before"),
        F.struct(F.lit(1).alias("there"), *payload).alias("head"))
    joined = inside.join(heads, (F.col("range") == F.col("before")) & F.col("next").isNull(), "left")
    following = F.coalesce("next", "head")
    keep = [c for c in inside.columns if c not in ("range", "next")]
    return joined.select(*keep, *[following[c].alias(f"next_{c}") for c in payload])


def _hex(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def own(rows: DataFrame) -> DataFrame:
        return syncmers(rows, prefix="own_").withColumn("fp", fingerprint(F.col("own_anchors"))).drop("own_anchors")

    pairs = with_next(docs, own, ["text", "fp"])
    n = F.length("text")
    moved = F.floor(n / 3).cast("int")
    edited = (pairs.withColumn("n_chars", n.cast("long"))
              .withColumn("edited", F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 3) AS int))"),
                                             F.substring(F.col("next_text"), F.lit(1), moved)))
              .drop("text", "next_text"))
    both = (syncmers(edited, text_col="edited", prefix="ed_").withColumn("edited_fp", fingerprint(F.col("ed_anchors")))
            .drop("ed_anchors"))
    return both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       _hex(F.col("fp")).alias("fingerprint"), _hex(F.col("edited_fp")).alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                       likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
