"""Schema evolution, safe type widening and table migration with validation.

A schema change is a list of steps applied with one ``select`` (no data rewrite). Files
written under an older schema are read by applying the later steps to them, which gives
old rows NULLs for added columns and carries data across renames.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.hashing import content_checksum


@dataclass(frozen=True)
class AddColumn:
    name: str
    dtype: str
    first: bool = False
    after: str | None = None
    comment: str | None = None


@dataclass(frozen=True)
class RenameColumn:
    old: str
    new: str


@dataclass(frozen=True)
class DropColumn:
    name: str


@dataclass(frozen=True)
class WidenColumn:
    name: str
    dtype: str


Change = AddColumn | RenameColumn | DropColumn | WidenColumn

_INT_RANK = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4}


def is_safe_widening(src: T.DataType, dst: T.DataType) -> bool:
    """Allowed promotions: int → bigint (any narrower integer), float → double, and decimal
    precision increase at the same scale. Everything else (e.g. double → string) is refused."""
    if src == dst:
        return True
    if type(src) in _INT_RANK and type(dst) in _INT_RANK:
        return _INT_RANK[type(src)] <= _INT_RANK[type(dst)]
    if isinstance(src, T.FloatType) and isinstance(dst, T.DoubleType):
        return True
    if isinstance(src, T.DecimalType) and isinstance(dst, T.DecimalType):
        return dst.scale == src.scale and dst.precision >= src.precision
    return False


def _apply(df: DataFrame, ch: Change) -> DataFrame:
    cols = list(df.columns)
    if isinstance(ch, AddColumn):
        if ch.name in cols:
            raise ValueError(f"column {ch.name} already exists")
        meta = {"comment": ch.comment} if ch.comment else {}
        new = F.lit(None).cast(ch.dtype).alias(ch.name, metadata=meta)
        exprs = [F.col(c) for c in cols]
        if ch.first:
            exprs.insert(0, new)
        elif ch.after is not None:
            if ch.after not in cols:
                raise ValueError(f"column {ch.after} not found")
            exprs.insert(cols.index(ch.after) + 1, new)
        else:
            exprs.append(new)
        return df.select(*exprs)
    if isinstance(ch, RenameColumn):
        if ch.old not in cols:
            raise ValueError(f"column {ch.old} not found")
        return df.withColumnsRenamed({ch.old: ch.new})
    if isinstance(ch, DropColumn):
        if ch.name not in cols:
            raise ValueError(f"column {ch.name} not found")
        return df.drop(ch.name)
    if isinstance(ch, WidenColumn):
        src = df.schema[ch.name].dataType
        dst = T._parse_datatype_string(ch.dtype)  # noqa: SLF001
        if not is_safe_widening(src, dst):
            raise TypeError(f"cannot change {ch.name} from {src.simpleString()} to {dst.simpleString()}")
        return df.withColumn(ch.name, F.col(ch.name).cast(dst))
    raise TypeError(f"unknown change {ch!r}")


def evolve_schema(df: DataFrame, changes: Sequence[Change]) -> DataFrame:
    """Apply schema changes in order (ADD [FIRST|AFTER], RENAME, DROP, ALTER TYPE)."""
    for ch in changes:
        df = _apply(df, ch)
    return df


def widen_column(df: DataFrame, name: str, dtype: str) -> DataFrame:
    return _apply(df, WidenColumn(name, dtype))


def read_versions(parts: Sequence[tuple[DataFrame, Sequence[Change]]]) -> DataFrame:
    """Union data written under several schema versions, each brought forward by the
    changes made after it was written; columns are matched by name."""
    out = None
    for df, later in parts:
        cur = evolve_schema(df, later)
        out = cur if out is None else out.unionByName(cur, allowMissingColumns=True)
    return out


def null_backfill_count(df: DataFrame, column: str, filter_col: str, values: Sequence[str]) -> DataFrame:
    """Rows (among ``filter_col IN values``) whose evolved ``column`` is NULL: one count."""
    return df.agg(F.count_if(F.col(filter_col).isin(list(values)) & F.col(column).isNull())
                  .alias("null_rows"))


def migrate_table(spark: SparkSession, df: DataFrame, name: str, location: str,
                  partition_by: Sequence[str] = (), replace: bool = True,
                  properties: dict[str, str] | None = None) -> DataFrame:
    """CTAS: create a catalog table at ``location`` from ``df`` (typed, optionally partitioned).

    With ``replace`` the new table is complete under a staging name before the old one goes, so
    a write that fails leaves the old table as it was.
    """
    staged = f"{name}__staged" if replace else name
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
    w = df.write.format("parquet").option("path", location).mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(staged)
    for k, v in (properties or {}).items():
        spark.sql(f"ALTER TABLE {staged} SET TBLPROPERTIES ('{k}' = '{v}')")
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    return spark.table(name)


def validate_migration(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row comparing schema (by name and type), row counts and a content checksum.

    Column order may differ (partition columns move last), so columns are compared by
    name and hashed in sorted-name order.
    """
    s_types = {f.name: f.dataType for f in source.schema.fields}
    t_types = {f.name: f.dataType for f in target.schema.fields}
    schema_match = s_types == t_types
    cols = sorted(s_types)
    s = source.agg(F.count(F.lit(1)).alias("source_rows"), content_checksum(source, cols).alias("s_sum"))
    t = target.agg(F.count(F.lit(1)).alias("target_rows"), content_checksum(target, cols).alias("t_sum")) \
        if schema_match else target.agg(F.count(F.lit(1)).alias("target_rows"),
                                        F.lit(None).cast("decimal(38,0)").alias("t_sum"))
    # both sides are single rows: attach target numbers as scalar subqueries
    out = s.select(
        "source_rows",
        t.select("target_rows").scalar().alias("target_rows"),
        F.lit(schema_match).alias("schema_match"),
        F.coalesce(F.col("s_sum").eqNullSafe(t.select("t_sum").scalar()), F.lit(False)).alias("checksum_match"),
    )
    return out.withColumn("valid", F.col("schema_match") & F.col("checksum_match")
                          & (F.col("source_rows") == F.col("target_rows")))


def assert_migration(source: DataFrame, target: DataFrame) -> None:
    """Raise when ``validate_migration`` reports a difference."""
    row = validate_migration(source, target).first()
    if not row["valid"]:
        raise ValueError(f"migration mismatch: {row.asDict()}")
