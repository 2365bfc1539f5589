"""Published tables whose columns have identities: files of every schema are read as one table.

Each column gets a number when it is added and keeps it for good. Every published version bears a
registry of the schemas so far, each with the version from which it was in force, so a file's schema
follows from its generation. Old files are read by number: a renamed column is found under its old
name, a dropped one is not read, and a name that is used again is a new column, null in the files of
the old one. A schema change publishes a version that names the same files, so it costs no rewrite.
The numbers are also written into the Parquet files as field ids, for other readers.

Changes are those of ``operators.evolve`` (add, rename, drop, safe widening), on columns that the
table is not partitioned by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.evolve import AddColumn, Change, DropColumn, RenameColumn, WidenColumn, is_safe_widening
from tidewater.sources import published as P

LAST_ID = "last_field_id"


def _field(f: T.StructField, number: int) -> T.StructField:
    return T.StructField(f.name, f.dataType, True, {**f.metadata, P.FIELD_ID: number})


def _registry(properties: dict, schema: T.StructType, since: int) -> dict:
    entry = {"since": since, "schema": schema.jsonValue()}
    return {**properties, P.SCHEMAS: [*properties.get(P.SCHEMAS, []), entry]}


def create(spark: SparkSession, path: str, schema: T.StructType, partition_cols: Sequence[str] = ()) -> P.Version:
    """Publish an empty table with numbered columns."""
    fields = [f if f.name in partition_cols else _field(f, i + 1) for i, f in enumerate(schema.fields)]
    numbered = T.StructType(fields)
    rows = spark.createDataFrame([], numbered)
    return P.commit(spark, path, P.stage(rows, path, partition_cols, 1), numbered, partition_cols, "create", 1,
                    _registry({LAST_ID: len(fields)}, numbered, 1))


def changed(schema: T.StructType, change: Change, last_id: int, fixed: Sequence[str] = ()) -> tuple[T.StructType, int]:
    """(schema after the change, last number given)."""
    fields, names = list(schema.fields), schema.names

    def at(name: str) -> int:
        if name not in names:
            raise ValueError(f"column {name} not found")
        if name in fixed:
            raise ValueError(f"the table is partitioned by {name}")
        return names.index(name)

    if isinstance(change, AddColumn):
        if change.name in names:
            raise ValueError(f"column {change.name} already exists")
        meta = {"comment": change.comment} if change.comment else {}
        place = 0 if change.first else names.index(change.after) + 1 if change.after in names else len(fields)
        if change.after is not None and change.after not in names:
            raise ValueError(f"column {change.after} not found")
        last_id += 1
        fields.insert(place, _field(T.StructField(change.name, T._parse_datatype_string(change.dtype), True, meta), last_id))  # noqa: SLF001
    elif isinstance(change, RenameColumn):
        k = at(change.old)
        if change.new in names:
            raise ValueError(f"column {change.new} already exists")
        fields[k] = T.StructField(change.new, fields[k].dataType, True, fields[k].metadata)
    elif isinstance(change, DropColumn):
        del fields[at(change.name)]
    elif isinstance(change, WidenColumn):
        k = at(change.name)
        wide = T._parse_datatype_string(change.dtype)  # noqa: SLF001
        if not is_safe_widening(fields[k].dataType, wide):
            raise TypeError(f"cannot change {change.name} from {fields[k].dataType.simpleString()} to {wide.simpleString()}")
        fields[k] = T.StructField(change.name, wide, True, fields[k].metadata)
    else:
        raise TypeError(f"unknown change {change!r}")
    return T.StructType(fields), last_id


def alter(spark: SparkSession, path: str, changes: Sequence[Change]) -> P.Version:
    """Publish the table with another schema; no file is written or read."""
    base = P.version_at(spark, path)
    schema, last_id = base.schema, base.properties[LAST_ID]
    for change in changes:
        schema, last_id = changed(schema, change, last_id, base.partition_cols)
    files = P.live_files(spark, path, base)
    properties = _registry({**base.properties, LAST_ID: last_id}, schema, base.number + 1)
    return P.commit(spark, path, files, schema, base.partition_cols, "alter", base.number + 1, properties)


def append(df: DataFrame, path: str) -> P.Version:
    """Publish ``df``, whose columns must be the table's present ones (in any order)."""
    spark = df.sparkSession
    base = P.version_at(spark, path)
    types = lambda s: {f.name: f.dataType for f in s.fields}
    if types(df.schema) != types(base.schema):
        raise ValueError(f"columns differ from the table's: {df.schema.simpleString()}, not {base.schema.simpleString()}")
    rows = df.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in base.schema.fields])
    staged = P.stage(rows, path, base.partition_cols, base.number + 1)
    files = P.live_files(spark, path, base).unionByName(staged)
    return P.commit(spark, path, files, base.schema, base.partition_cols, "append", base.number + 1, base.properties)


def read(spark: SparkSession, path: str, number: int | None = None, where: Column | None = None) -> DataFrame:
    """The table, all files under the schema of the version (by default the latest)."""
    return P.read_published(spark, path, number, where)
