"""Mixing sources to target weights (operator 1).

Tokens are summed per source, each source gets a repetition rate, and every document is
emitted ``floor(rate)`` times plus one hash-seeded Bernoulli copy with probability equal to
the fraction of the rate.

Scale: one partial aggregate over (source, size); everything after that works on one row per
source. Sources are numbered by a range sort (no single-task window), the resharing of capped
sources is a short loop of aggregates that brings two numbers to the driver, and the rates go
back to the documents by an equi-join that Spark broadcasts only when the measured size of the
written rate table allows it. A source with a third of all rows is only ever the streamed side.

Defined results: null or empty text has size 0; a null source is one source, ordered last; a
source of size 0 has target 0 and emits nothing; rows that repeat a document id share one draw;
an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.scratch import Scratch, with_row_numbers
from tidewater.tables import table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SEED = "mix-1"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row within its partition in these bits


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_draw(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on ``key`` and ``seed`` alone (52 bits of an MD5)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def _ranked_sources(sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """(source, source_size, place): sources numbered from 0 by code point, null last."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = with_row_numbers(totals.orderBy(F.col("source").asc_nulls_last()), scratch, "sources")
    part = F.shiftright("row", _ROW_BITS)
    counts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    before, offsets = 0, []
    for r in counts:  # one row per partition of the sorted source table
        offsets += [F.lit(r["part"]), F.lit(before)]
        before += r["n"]
    start = F.create_map(*offsets)[part] if offsets else F.lit(0)
    place = (start + F.col("row").bitwiseAND(F.lit(2**_ROW_BITS - 1))).alias("place")
    return ordered.select("source", "source_size", place)


def source_targets(sizes: DataFrame, scratch: Scratch, weights: Sequence[int] = WEIGHTS,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target) from a frame with ``source`` and ``size``.

    Sources weigh ``weights`` in turn and share the total of all sizes; a target stops at
    ``max_repeats`` times its source's size, and the excess is reshared by weight among the
    others until none is above.
    """
    ranked = _ranked_sources(sizes, scratch)
    turn = F.array(*[F.lit(int(w)) for w in weights])
    weight = F.element_at(turn, (F.col("place") % len(weights) + 1).cast("int")).cast("long")
    w = ranked.select("source", F.col("source_size").cast("long").alias("source_size"), weight.alias("weight"))
    cap = F.col("source_size") * max_repeats
    total, level, capped = 0, 0.0, -1
    while True:
        # below: sources whose cap lies under their share of the present level
        below = F.when(F.lit(capped >= 0) & (F.lit(level) * F.col("weight") > cap), 1).otherwise(0)
        got = w.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("total"), F.sum(below).alias("capped"),
                    F.sum(F.when(below == 1, cap).otherwise(0)).alias("held"),
                    F.sum(F.when(below == 0, F.col("weight")).otherwise(0)).alias("weights")).first()
        if got["capped"] == capped or not got["weights"]:
            break
        total, capped = got["total"], got["capped"]
        level = (total - got["held"]) / got["weights"]
    target = F.least(F.lit(level) * F.col("weight"), cap.cast("double"))
    return w.select("source", "source_size", target.alias("target"))


def _copies(rate: Column, key: Column, seed: str) -> Column:
    return (F.floor(rate) + F.when(unit_draw(key, seed) < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def _rate() -> Column:
    return F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies."""
    scratch = Scratch(docs.sparkSession, "mix")
    sizes = scratch.save(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                     word_count(F.col(text_col)).alias("size")), "sizes")
    targets = scratch.save(source_targets(sizes, scratch, weights, max_repeats), "targets")
    scratch.drop("sources")
    t = targets.withColumnRenamed("source", "of_source")
    joined = sizes.join(t, F.col("source").eqNullSafe(F.col("of_source")))
    return joined.select("doc_id", "source", "size", "source_size", "target",
                         _copies(_rate(), F.col("doc_id"), seed).alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """The mix itself: every row of ``docs``, all its columns, as often as the mix takes it."""
    scratch = Scratch(docs.sparkSession, "mix")
    sizes = docs.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    targets = scratch.save(source_targets(sizes, scratch, weights, max_repeats), "targets")
    scratch.drop("sources")
    t = targets.select(F.col("source").alias("of_source"), _rate().alias("rate"))
    kept = docs.select(F.struct("*").alias("doc"), F.col(source_col).alias("source"), F.col(id_col).alias("key"))
    joined = kept.join(t, F.col("source").eqNullSafe(F.col("of_source")))
    copies = _copies(F.col("rate"), F.col("key"), seed)
    repeated = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return (joined.select("doc", copies.alias("copies")).where(F.col("copies") > 0)
            .select("doc", repeated.alias("copy")).select("doc.*"))


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP1_SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY source_size * 3.0 / w, source NULLS LAST) AS k FROM r),
c AS (SELECT *, coalesce(sum(source_size * 3) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
             sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
             sum(source_size) OVER () AS total FROM o),
l AS (SELECT arg_min(CAST(total - held AS DOUBLE) / CAST(open AS DOUBLE), k) AS level FROM c
      WHERE (CAST(total - held AS DOUBLE) / CAST(open AS DOUBLE)) * w <= source_size * 3),
t AS (SELECT source, source_size, least(level * w, CAST(source_size * 3 AS DOUBLE)) AS target FROM r, l),
j AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
             CAST(CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE)
               / 4503599627370496.0 AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM j
"""
