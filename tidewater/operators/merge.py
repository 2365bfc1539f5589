"""Row-level DML on immutable files: MERGE (upsert), UPDATE … WHERE, DELETE … WHERE.

Parquet has no MERGE/UPDATE/DELETE, so each statement is a DataFrame that produces the
table's next state; the caller writes it (see ``sources.sinks``). A MERGE joins the target with
the source from the target's side: a source below the broadcast bound never makes the target
move. Rows to insert are the source rows whose key is not among the matched keys, which are at
most as many as the source's.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.sizing import broadcast_if_small
from tidewater.operators.dedup import _as_list, validate_columns


def _sides(target: DataFrame, source: DataFrame, keys: list[str]):
    """(target ⟕ source, source rows without a target row); sides are structs ``t`` and ``s``.

    ``n`` is how many source rows share the key. A NULL key matches nothing.
    """
    validate_columns(target, keys)
    validate_columns(source, keys)
    t = target.select(F.struct("*").alias("t"), *[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)])
    s = source.select(F.struct("*").alias("s"), *[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)])
    names = [f"_s{i}" for i in range(len(keys))]
    on = [F.col(f"_t{i}") == F.col(f"_s{i}") for i in range(len(keys))]
    s = s.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*names)))
    joined = t.join(broadcast_if_small(s), on, "left").select("t", "s", "n")
    wanted = broadcast_if_small(source.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).distinct())
    matched = (target.select(*[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)])
               .join(wanted, on, "left_semi").distinct())
    fresh = s.drop("n").join(broadcast_if_small(matched), on, "left_anti").select("s")
    return joined, fresh


def _take(newer_col: str | None) -> Column:
    """Whether a matched row is updated: always, or when the source is not older."""
    matched = F.col("s").isNotNull()
    if newer_col is None:
        return matched
    newer = F.coalesce(F.col(f"s.{newer_col}") >= F.col(f"t.{newer_col}"), F.col(f"t.{newer_col}").isNull())
    return matched & newer


def merge_into(target: DataFrame, source: DataFrame, keys: str | Sequence[str],
               newer_col: str | None = None) -> DataFrame:
    """MERGE INTO target USING source ON keys: matched → UPDATE SET *, not matched → INSERT *.

    Columns are the target's, followed by any new source columns (schema evolution on
    merge); a column that only the target has keeps its value in updated rows and is NULL in
    inserted ones. With ``newer_col`` a matched row is only updated when the source is not
    older. A target row matched by several source rows is an error, raised by the job.
    """
    keys = _as_list(keys)
    joined, fresh = _sides(target, source, keys)
    take = _take(newer_col)
    cols = list(target.columns) + [c for c in source.columns if c not in target.columns]
    types = {f.name: f.dataType for f in [*source.schema.fields, *target.schema.fields]}
    twice = F.raise_error(F.lit("MERGE: several source rows match one target row"))
    old, new = [], []
    for c in cols:
        here, there = c in target.columns, c in source.columns
        kept = F.col(f"t.{c}") if here else F.lit(None).cast(types[c])
        value = F.when(take, F.col(f"s.{c}").cast(types[c])).otherwise(kept) if there and c not in keys else kept
        # in every column, so that no projection above can lose the check
        old.append(F.when(F.col("n") > 1, twice.cast(types[c])).otherwise(value).alias(c))
        new.append((F.col(f"s.{c}").cast(types[c]) if there else F.lit(None).cast(types[c])).alias(c))
    return joined.select(*old).unionByName(fresh.select(*new))


def merge_actions(target: DataFrame, source: DataFrame, keys: str | Sequence[str],
                  newer_col: str | None = None) -> DataFrame:
    """One row of MERGE metrics and the row-count invariant the upstream job only logged.

    ``valid`` compares the actions with counts taken from the sides themselves: every target
    row has one action, every source row is used once, and the result has as many rows as the
    target plus the inserts. A target row that is matched twice makes it false.
    """
    keys = _as_list(keys)
    joined, fresh = _sides(target, source, keys)
    take, hit = _take(newer_col), F.col("s").isNotNull()
    actions = joined.agg(
        F.count_if(take).alias("rows_updated"), F.count_if(hit & ~take).alias("rows_skipped"),
        F.count_if(~hit).alias("rows_untouched"), F.count(F.lit(1)).alias("_joined"))
    one = lambda df: df.select(F.count(F.lit(1))).scalar()
    counted = actions.select("*", one(target).alias("target_rows_before"), one(source).alias("source_rows"),
                             one(fresh).alias("rows_inserted"))
    after = F.col("_joined") + F.col("rows_inserted")
    valid = ((F.col("rows_updated") + F.col("rows_skipped") + F.col("rows_untouched") == F.col("target_rows_before"))
             & (F.col("rows_updated") + F.col("rows_skipped") + F.col("rows_inserted") == F.col("source_rows"))
             & (after == F.col("target_rows_before") + F.col("rows_inserted")))
    return counted.select("target_rows_before", "source_rows", "rows_updated", "rows_skipped", "rows_inserted",
                          "rows_untouched", after.alias("target_rows_after"), valid.alias("valid"))


def update_where(df: DataFrame, predicate: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """UPDATE … SET col = expr WHERE predicate; a NULL predicate leaves the row unchanged."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.withColumns({c: F.when(hit, e.cast(df.schema[c].dataType)).otherwise(F.col(c))
                           for c, e in assignments.items()})


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """DELETE … WHERE predicate: keep rows where it is not TRUE (NULL survives)."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def delete_keys(df: DataFrame, to_delete: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Delete every row whose key appears in ``to_delete`` (left anti join, skew-safe:
    the delete list is deduplicated first so a hot key cannot fan out)."""
    keys = _as_list(keys)
    return df.join(to_delete.select(*keys).distinct(), keys, "left_anti")


def deleted_count(df: DataFrame, to_delete: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows removed by ``delete_keys`` as a one-row count (the DELETE status number)."""
    keys = _as_list(keys)
    hit = df.join(to_delete.select(*keys).distinct(), keys, "left_semi")
    return hit.agg(F.count(F.lit(1)).alias("deleted_rows"))
