"""Published tables: Parquet files that readers see through one manifest, replaced by one rename.

A writer stages its rows in a folder of its own, checks them against what the write itself counted,
writes a manifest (one row per live data file) and publishes it by renaming a small version file into
place. Until that rename nothing that it did is visible, and after it everything is: a job that dies
at any earlier point leaves files that no version names, and its rerun starts afresh. A rename that
finds the version taken fails, so of two jobs that started from one version only one gets through.

    data/gen=<version>-<attempt>/<partition>=<value>/part-…   rows, never changed once written
    manifests/<version>-<attempt>/                            file, bytes, rows, partition values
    versions/<version>.json                                   which manifest, its totals, the schema

Files are shared between versions: a job that rewrites a few of them names the others again.
The folder must be on a file system with an atomic rename (HDFS, a local disk). The list of live
files passes through the driver, as it does for any file scan that Spark plans; rows never do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.hashing import content_checksum
from tidewater.session import drop_path, path_exists

GEN = "gen"
FIELD_ID = "parquet.field.id"
SCHEMAS = "schemas"
_DIGITS = 12


class CommitConflict(RuntimeError):
    """Another job published the version that this one was about to."""


@dataclass(frozen=True)
class Version:
    """A published state of a table."""

    number: int
    manifest: str
    operation: str
    files: int
    rows: int
    bytes: int
    checksum: str
    partition_cols: tuple[str, ...]
    schema: T.StructType
    properties: dict = field(default_factory=dict)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p  # noqa: SLF001


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _put_if_absent(spark: SparkSession, path: str, text: str) -> None:
    """Write ``text`` beside ``path`` and rename it into place; an existing ``path`` is never replaced."""
    fs, p = _fs(spark, path)
    sc = spark.sparkContext
    jvm, gateway = sc._jvm, sc._gateway  # noqa: SLF001
    staged = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(staged, False)
    out.write(text.encode())
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())  # noqa: SLF001
    try:
        context.rename(fs.makeQualified(staged), fs.makeQualified(p),
                       gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as e:
        fs.delete(staged, False)
        if fs.exists(p):
            raise CommitConflict(f"{path} is already published") from e
        raise


def version_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published versions, oldest first."""
    return [int(n[:-5]) for n in _names(spark, f"{path}/versions") if n.endswith(".json") and n[:-5].isdigit()]


def version_at(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The named version, or the latest; None for a table that was never published."""
    there = version_numbers(spark, path)
    if number is None and not there:
        return None
    number = there[-1] if number is None else number
    if number not in there:
        raise ValueError(f"version {number} of {path} is not published")
    text = spark.read.text(f"{path}/versions/{number:0{_DIGITS}d}.json", wholetext=True).first()[0]
    v = json.loads(text)
    return Version(number, v["manifest"], v["operation"], v["files"], v["rows"], v["bytes"], v["checksum"],
                   tuple(v["partition_cols"]), T.StructType.fromJson(v["schema"]), v["properties"])


def manifest_schema(version: Version) -> T.StructType:
    values = T.StructType([T.StructField(c, version.schema[c].dataType) for c in version.partition_cols] or [T.StructField("all", T.IntegerType())])
    return T.StructType([T.StructField("file", T.StringType()), T.StructField("bytes", T.LongType()),
                         T.StructField("rows", T.LongType()), T.StructField("partition", values)])


def _totals(files: DataFrame):
    """Files, rows, bytes and an order-free checksum over a manifest's rows."""
    each = F.xxhash64("file", "bytes", "rows").cast("decimal(38,0)")
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                     F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.coalesce(F.sum(each), F.lit(0)).cast("string").alias("checksum")).first()


def live_files(spark: SparkSession, path: str, version: Version) -> DataFrame:
    """(file, bytes, rows, partition) of a version's data files, checked against its totals."""
    files = spark.read.schema(manifest_schema(version)).parquet(f"{path}/manifests/{version.manifest}")
    got = _totals(files)
    if (got["files"], got["rows"], got["bytes"], got["checksum"]) != (version.files, version.rows, version.bytes, version.checksum):
        raise RuntimeError(f"manifest {version.manifest} of {path} differs from what version {version.number} published")
    return files


def relative_file(file_path: Column | None = None) -> Column:
    """A data file's path below ``data``, from the (URL-encoded) path that a scan reports."""
    encoded = F.regexp_extract(F.col("_metadata.file_path") if file_path is None else file_path, rf"^.*/data/({GEN}=\d+-[0-9a-f]+/.*)$", 1)
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def _written_under(version: Version, file: str) -> T.StructType:
    """The schema that a file was written under: the last one in force at its generation."""
    generation = int(file[len(GEN) + 1:].split("-")[0])
    known = [T.StructType.fromJson(e["schema"]) for e in version.properties.get(SCHEMAS, []) if e["since"] <= generation]
    return known[-1] if known else version.schema


def _scan(spark: SparkSession, path: str, version: Version, schema: T.StructType, files: Sequence[str], extra: dict[str, Column]) -> DataFrame:
    """Rows of files written under ``schema``, under the version's: columns are matched by their numbers."""
    inside = [f for f in schema.fields if f.name not in version.partition_cols]
    dealt = [version.schema[c] for c in version.partition_cols]
    read = T.StructType([*inside, T.StructField(GEN, T.StringType()), *dealt])
    rows = spark.read.schema(read).option("basePath", f"{path}/data").parquet(*[f"{path}/data/{f}" for f in files])
    named = {f.metadata.get(FIELD_ID, f.name): f for f in schema.fields}

    def column(f: T.StructField) -> Column:
        old = named.get(f.metadata.get(FIELD_ID, f.name))
        if old is None:
            return F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata)
        c = F.col(f"`{old.name}`")
        return (c if old.dataType == f.dataType else c.cast(f.dataType)).alias(f.name, metadata=f.metadata)

    return rows.select(*[column(f) for f in version.schema.fields], *[c.alias(name) for name, c in extra.items()])


def read_files(spark: SparkSession, path: str, version: Version, files: Sequence[str], extra: dict[str, Column] | None = None) -> DataFrame:
    """The rows of some of a version's files, and ``extra`` columns, which may use the scan's ``_metadata``.

    Files of one schema are one scan, so there are as many scans as schemas that live files were
    written under; filters and column pruning reach each under its own names.
    """
    if not files:
        return spark.createDataFrame([], version.schema)
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for f in files:
        schema = _written_under(version, f)
        groups.setdefault(schema.json(), (schema, []))[1].append(f)
    return reduce(DataFrame.unionByName, [_scan(spark, path, version, schema, some, extra or {}) for schema, some in groups.values()])


def read_published(spark: SparkSession, path: str, number: int | None = None, where: Column | None = None) -> DataFrame:
    """The table as published (by default the latest version), in its schema's column order.

    ``where`` chooses files by their manifest row, for instance ``F.col("partition.day") > "2024-01-01"``;
    others are neither listed nor opened.
    """
    version = version_at(spark, path, number)
    if version is None:
        raise FileNotFoundError(f"{path} holds no published version")
    live = live_files(spark, path, version)
    files = [r["file"] for r in (live if where is None else live.where(where)).select("file").collect()]
    return read_files(spark, path, version, files).select(*version.schema.names)


def stage(df: DataFrame, path: str, partition_cols: Sequence[str] = (), number: int = 1) -> DataFrame:
    """Write ``df`` below a fresh generation folder and return its files (file, bytes, rows, partition).

    The write itself counts its rows and sums up their hashes; the files are read back and must agree.
    """
    spark = df.sparkSession
    if GEN in df.columns:
        raise ValueError(f"column {GEN!r} is reserved for the generation folders")
    folder = f"{path}/data/{GEN}={number:06d}-{uuid.uuid4().hex[:8]}"
    # observed right before the writer: its tasks commit once each, however often one is tried
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), content_checksum(df).alias("checksum"))
    w = observed.write.mode("errorifexists")
    (w.partitionBy(*partition_cols) if partition_cols else w).parquet(folder)
    written = spark.read.schema(df.schema).parquet(folder)
    back = written.agg(F.count(F.lit(1)).alias("rows"), content_checksum(written).alias("checksum")).first()
    if (back["rows"], back["checksum"]) != (seen.get["rows"], seen.get["checksum"]):
        raise RuntimeError(f"{folder} does not hold what was written to it")
    values = F.struct(*[F.col(c) for c in partition_cols]) if partition_cols else F.struct(F.lit(None).cast("int").alias("all"))
    return written.groupBy(relative_file().alias("file"), F.col("_metadata.file_size").alias("bytes"), values.alias("partition")).agg(
        F.count(F.lit(1)).alias("rows")).select("file", "bytes", "rows", "partition")


def commit(spark: SparkSession, path: str, files: DataFrame, schema: T.StructType, partition_cols: Sequence[str],
           operation: str, number: int, properties: dict | None = None) -> Version:
    """Publish ``files`` (file, bytes, rows, partition) as version ``number``, with any JSON ``properties``.

    Raises ``CommitConflict``, and changes nothing, where that version exists.
    """
    name = f"{number:0{_DIGITS}d}-{uuid.uuid4().hex[:8]}"
    folder = f"{path}/manifests/{name}"
    version = Version(number, name, operation, 0, 0, 0, "", tuple(partition_cols), schema)
    files.select("file", "bytes", "rows", "partition").write.parquet(folder)
    got = _totals(spark.read.schema(manifest_schema(version)).parquet(folder))
    totals = {k: got[k] for k in ("files", "rows", "bytes", "checksum")}
    _put_if_absent(spark, f"{path}/versions/{number:0{_DIGITS}d}.json", json.dumps(
        {"manifest": name, "operation": operation, **totals, "partition_cols": list(partition_cols), "schema": schema.jsonValue(),
         "properties": properties or {}}))
    return Version(number, name, operation, got["files"], got["rows"], got["bytes"], got["checksum"], tuple(partition_cols), schema,
                   properties or {})


def publish(df: DataFrame, path: str, partition_cols: Sequence[str] = (), mode: str = "append") -> Version:
    """Append ``df`` to the table at ``path``, or replace its rows (``mode="replace"``), as one new version.

    The first call makes the table. Appended rows must have the table's columns and types (in any
    order); ``partition_cols`` is read from the table once there is one.
    """
    spark = df.sparkSession
    if mode not in ("append", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    base = version_at(spark, path)
    if base is not None:
        partition_cols = base.partition_cols
    if base is not None and mode == "append":
        types = lambda s: {f.name: f.dataType for f in s.fields}
        if types(df.schema) != types(base.schema):
            raise ValueError(f"columns differ from the table's: {df.schema.simpleString()}, not {base.schema.simpleString()}")
        df = df.select(*base.schema.names)
    number = base.number + 1 if base else 1
    files = stage(df, path, partition_cols, number)
    if base is not None and mode == "append":
        files = live_files(spark, path, base).unionByName(files)
    schema = base.schema if base is not None and mode == "append" else T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    return commit(spark, path, files, schema, partition_cols, mode, number)


def history(spark: SparkSession, path: str) -> DataFrame:
    """One row per published version: number, operation, files, rows, bytes."""
    rows = spark.read.schema("operation string, files long, rows long, bytes long").json(f"{path}/versions/*.json")
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)\.json$", 1).cast("long").alias("version")
    return rows.select(number, "operation", "files", "rows", "bytes")


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete what only versions older than the last ``keep`` name, and what interrupted jobs left.

    Folders of versions that are still being written have higher numbers than the latest and stay.
    Returns the deleted folders.
    """
    numbers = version_numbers(spark, path)
    if not numbers:
        return []
    kept = [version_at(spark, path, n) for n in numbers[-keep:]]
    named, manifests = set(), {v.manifest for v in kept}
    for v in kept:
        gens = live_files(spark, path, v).select(F.split("file", "/")[0].alias("g")).distinct()
        named |= {r["g"] for r in gens.collect()}  # one name a generation
    for n in numbers[:-keep]:
        drop_path(spark, f"{path}/versions/{n:0{_DIGITS}d}.json")
    gone = [f"{path}/data/{g}" for g in _names(spark, f"{path}/data")
            if g.startswith(f"{GEN}=") and g not in named and int(g[len(GEN) + 1:].split("-")[0]) <= numbers[-1]]
    gone += [f"{path}/manifests/{m}" for m in _names(spark, f"{path}/manifests")
             if m not in manifests and int(m.split("-")[0]) <= numbers[-1]]
    for folder in gone:
        drop_path(spark, folder)
    return gone


def is_published(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/versions")
