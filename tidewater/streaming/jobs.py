"""Structured Streaming twins of the batch jobs.

* ``stream_collect``: landed response envelopes → items → streaming dedup on the item id.
* ``stream_landing``: landed lines → envelopes, with malformed ones as rejects and counts that add up.
* ``stream_first_and_late``: the dedup with remembered ids that expire; late rows are tagged output.
* ``stream_increment``: a file source is its own high-water mark: the checkpoint records
  which files were read, so each run (``availableNow``) picks up only new files.
* ``stream_upsert``: ``foreachBatch`` upsert (last write wins). A micro-batch is appended as
  one folder of a log, and reading the log resolves it, so no batch rewrites the table and
  replaying an epoch gives the same log.

Checkpoints and tables live in the caller's shared folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.dedup import dedup_lww
from tidewater.session import drop_path, path_exists
from tidewater.sources.collector import ENVELOPE_SCHEMA, accepted, landed_lines, parse_envelopes, rejected
from tidewater.sources.sinks import TEXT_OPTIONS


def _run(writer, timeout_s: int | None = None):
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination(timeout_s)
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def stream_collect(spark: SparkSession, envelope_dir: str, out_path: str, checkpoint: str,
                   watermark: str | None = None, files_per_trigger: int = 1) -> DataFrame:
    """Items from landed envelopes, first copy per id, appended to ``out_path``.

    Without ``watermark`` the dedup state grows with the number of ids (unbounded, as the
    upstream collector's in-memory set); with it, ``dropDuplicatesWithinWatermark`` bounds
    state by event time and drops rows that are later than that: ``late_items`` finds them.
    """
    env = (spark.readStream.schema(ENVELOPE_SCHEMA).options(**TEXT_OPTIONS)
           .option("maxFilesPerTrigger", files_per_trigger).json(envelope_dir))
    items = (env.filter(F.col("status") == "ok")
             .select(F.explode("data").alias("item")).select("item.*")
             .filter(F.col("id").isNotNull() & (F.col("id") != "")))
    if watermark:
        items = items.withColumn("_ts", F.col("ts").cast("timestamp")).withWatermark("_ts", watermark) \
            .dropDuplicatesWithinWatermark(["id"]).drop("_ts")
    else:
        items = items.dropDuplicates(["id"])
    _run(items.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return spark.read.schema(items.schema).parquet(out_path)


def stream_increment(spark: SparkSession, source_dir: str, schema: T.StructType, out_path: str,
                     checkpoint: str, ts_col: str | None = None, mark=None) -> DataFrame:
    """Append every not-yet-seen file's rows (optionally ``ts_col > mark``) to ``out_path``."""
    src = spark.readStream.schema(schema).parquet(source_dir)
    if ts_col is not None and mark is not None:
        src = src.filter(F.col(ts_col) > F.lit(mark).cast(schema[ts_col].dataType))
    _run(src.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return spark.read.schema(src.schema).parquet(out_path)


def late_items(spark: SparkSession, envelope_dir: str, collected: DataFrame) -> DataFrame:
    """Landed items with an id that are missing from a collected table: what a watermark dropped."""
    env = spark.read.schema(ENVELOPE_SCHEMA).options(**TEXT_OPTIONS).json(envelope_dir)
    items = env.filter(F.col("status") == "ok").select(F.explode("data").alias("item")).select("item.*")
    return items.filter(F.col("id").isNotNull() & (F.col("id") != "")).join(collected.select("id"), "id", "left_anti")


# ---- a landing with rejects -------------------------------------------------------------------

def stream_landing(spark: SparkSession, landing: str, out: str, checkpoint: str, files_per_trigger: int = 1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(accepted envelopes, rejects, counts per micro-batch) of JSON Lines as they land.

    The micro-batch's own writes count their rows, and the counts (landed, accepted, rejected) are
    written last, so a counted epoch is a whole one. A replayed epoch replaces its own folders; one
    whose parts do not add up to what landed raises.
    """
    lines = landed_lines(spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(landing))
    parsed = parse_envelopes(lines, options=TEXT_OPTIONS)

    def put(df: DataFrame, name: str, epoch: int) -> int:
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").parquet(f"{out}/{name}/{EPOCH_COLUMN}={epoch}")
        return seen.get["rows"]

    def land(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            landed = batch.count()
            good, bad = put(accepted(batch), "accepted", epoch), put(rejected(batch), "rejected", epoch)
        finally:
            batch.unpersist()
        if good + bad != landed:
            raise RuntimeError(f"epoch {epoch}: {landed} lines landed, {good} accepted and {bad} rejected")
        counts = batch.sparkSession.createDataFrame([(landed, good, bad)], "landed bigint, accepted bigint, rejected bigint")
        counts.coalesce(1).write.mode("overwrite").parquet(f"{out}/counts/{EPOCH_COLUMN}={epoch}")

    _run(parsed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(land))
    whole = T.StructType([*ENVELOPE_SCHEMA.fields])
    read = lambda name, schema: spark.read.schema(schema).parquet(f"{out}/{name}")
    epoch = T.StructField(EPOCH_COLUMN, T.LongType())
    return (read("accepted", whole), read("rejected", "file string, reason string, line string"),
            read("counts", T.StructType([*[T.StructField(c, T.LongType()) for c in ("landed", "accepted", "rejected")], epoch])))


# ---- first copies and late rows of a bounded stream, from one pass over it ---------------------

FIRST, LATE = "first", "late"


def _ms() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


class FirstOrLate:
    """Per id: the first row is tagged ``first`` and remembered until ``keep_ms`` after its time.

    Later rows of a remembered id are repeats and give nothing. A row older than the watermark whose
    id is not remembered is tagged ``late``: whether it is a repeat can no longer be told.

    The remembered ids are a table (``seen``: id, until), one folder an epoch, and an epoch's clock is
    the newest time seen and the watermark up to which ids are forgotten. An epoch reads the one
    before it and replaces its own folders, so a replayed epoch gives the same.
    """

    def __init__(self, out_path: str, state: str, schema: T.StructType, delay_ms: int, keep_ms: int):
        self.out_path, self.state, self.schema = out_path, state, schema
        self.delay_ms, self.keep_ms = delay_ms, keep_ms
        self.held: list[int] = []
        self.epoch: int | None = None

    def _at(self, name: str, epoch: int) -> str:
        return f"{self.state}/{name}/{EPOCH_COLUMN}={epoch}"

    def _set_clock(self, spark: SparkSession, epoch: int, newest: int, forgotten: int) -> None:
        clock = spark.createDataFrame([(newest, forgotten)], "newest bigint, forgotten bigint")
        clock.coalesce(1).write.mode("overwrite").parquet(self._at("clock", epoch))

    def _clock(self, spark: SparkSession, epoch: int) -> tuple[int, int]:
        return tuple(spark.read.parquet(self._at("clock", epoch)).first())

    def _seen(self, spark: SparkSession, epoch: int, forgotten: int) -> DataFrame:
        seen = spark.read.schema("id string, until bigint").parquet(self._at("seen", epoch))
        return seen.where(F.col("until") > forgotten)

    def _watermark(self, newest: int) -> int:
        return max(0, newest - self.delay_ms)

    def tag(self, batch: DataFrame, epoch: int) -> None:
        """Write one micro-batch's tagged rows, then the ids remembered after it, then its clock."""
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            latest = batch.select(F.max(_ms())).first()[0] or 0
            newest, known = 0, None
            if path_exists(spark, self._at("clock", epoch - 1)):
                newest, forgotten = self._clock(spark, epoch - 1)
                known = self._seen(spark, epoch - 1, forgotten)
            watermark = self._watermark(newest)
            # a row without a time counts as one of 1970
            rows = batch.withColumn("ts", F.coalesce("ts", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")))
            late, timely = rows.where(_ms() < watermark), rows.where(_ms() >= watermark)
            if known is not None:
                late, timely = (r.join(known, "id", "left_anti") for r in (late, timely))
            order = [F.col(f.name).asc_nulls_last() for f in batch.schema.fields if f.name not in ("id", "ts")]
            w = Window.partitionBy("id").orderBy("ts", *order)
            first = timely.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")
            tagged = first.withColumn("tag", F.lit(FIRST)).unionByName(late.withColumn("tag", F.lit(LATE)))
            out = f"{self.out_path}/{EPOCH_COLUMN}={epoch}"
            tagged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("tag").parquet(out)
        finally:
            batch.unpersist()
        firsts = spark.read.schema(self.schema).parquet(out).where(F.col("tag") == FIRST)
        seen = firsts.select("id", (_ms() + self.keep_ms).alias("until"))
        seen = seen if known is None else seen.unionByName(known)
        seen.where(F.col("until") > watermark).write.mode("overwrite").parquet(self._at("seen", epoch))
        self._set_clock(spark, epoch, max(newest, latest), watermark)
        self.held.append(self._seen(spark, epoch, watermark).count())
        self.epoch = epoch
        for name in ("seen", "clock"):  # a replay goes back one epoch at most
            drop_path(spark, self._at(name, epoch - 2))

    def close(self, spark: SparkSession) -> None:
        """Forget what the last micro-batch's own times have made old."""
        if self.epoch is None:
            return
        newest, _ = self._clock(spark, self.epoch)
        self._set_clock(spark, self.epoch, newest, self._watermark(newest))
        self.held.append(self._seen(spark, self.epoch, self._watermark(newest)).count())


def stream_first_and_late(spark: SparkSession, envelope_dir: str, out_path: str, checkpoint: str, watermark: str,
                          keep_seconds: int, files_per_trigger: int = 1) -> tuple[DataFrame, list[int]]:
    """(items with a ``tag``, ids remembered after each micro-batch and at the end) of landed envelopes.

    The first copy of every id is tagged ``first``. Rows older than the watermark are not dropped
    but tagged ``late``, in the same pass and with the same checkpoint. State holds only ids whose time
    is less than ``keep_seconds`` behind the watermark; a row without a time has no place in a stream
    bounded by time and is late. The output is partitioned by epoch and tag. A micro-batch costs its
    own rows and the remembered ids, in joins and windows on the JVM, with no call per id.
    """
    env = (spark.readStream.schema(ENVELOPE_SCHEMA).options(**TEXT_OPTIONS)
           .option("maxFilesPerTrigger", files_per_trigger).json(envelope_dir))
    items = (env.filter(F.col("status") == "ok").select(F.explode("data").alias("item")).select("item.*")
             .filter(F.col("id").isNotNull() & (F.col("id") != "")))
    schema = T.StructType([*items.schema.fields, T.StructField("tag", T.StringType())])
    delay_ms = spark.sql(f"SELECT unix_millis(timestamp_millis(0) + INTERVAL '{watermark}')").first()[0]
    if delay_ms < 0:
        raise ValueError(f"a watermark's delay is not negative: {watermark}")
    job = FirstOrLate(out_path, f"{checkpoint}/first_or_late", schema, delay_ms, 1000 * keep_seconds)
    _run(items.writeStream.option("checkpointLocation", checkpoint).foreachBatch(job.tag))
    job.close(spark)
    if not path_exists(spark, out_path):  # nothing has landed yet
        return spark.createDataFrame([], schema), job.held
    full = T.StructType([*schema.fields, T.StructField(EPOCH_COLUMN, T.LongType())])
    return spark.read.schema(full).parquet(out_path).select(*schema.names), job.held


EPOCH_COLUMN = "_epoch"


def append_epoch(batch: DataFrame, epoch: int, log_path: str, keys: Sequence[str], ts_col: str,
                 order_by: Sequence[str]) -> None:
    """Write one micro-batch, one row per key, as its own folder of the log.

    The folder is named by the epoch and replaced as a whole, so a replayed epoch leaves the log
    as it was, and a crash leaves either no folder or one that the replay overwrites.
    """
    rows = dedup_lww(batch, list(keys), ts_col, list(order_by)).withColumn(EPOCH_COLUMN, F.lit(epoch).cast("bigint"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(EPOCH_COLUMN).parquet(log_path)


def read_upserted(spark: SparkSession, log_path: str, schema: T.StructType, keys: Sequence[str], ts_col: str,
                  order_by: Sequence[str] = ()) -> DataFrame:
    """The log's state: per key the newest row; an earlier epoch wins a tie."""
    full = T.StructType([*schema.fields, T.StructField(EPOCH_COLUMN, T.LongType())])
    log = spark.read.schema(full).parquet(log_path)
    return dedup_lww(log, list(keys), ts_col, [EPOCH_COLUMN, *order_by]).drop(EPOCH_COLUMN)


def stream_upsert(spark: SparkSession, source_dir: str, schema: T.StructType, target_path: str,
                  checkpoint: str, keys: Sequence[str], ts_col: str, order_by: Sequence[str] = (),
                  files_per_trigger: int = 1) -> DataFrame:
    """Streaming upsert (last write wins): micro-batches are appended to a log, the state is read
    from it. A batch costs its own size, whatever the table's; ``fold_log`` bounds the log."""
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir)
    _run(src.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, epoch: append_epoch(df, epoch, target_path, keys, ts_col, order_by)))
    return read_upserted(spark, target_path, schema, keys, ts_col, order_by)


def fold_log(spark: SparkSession, log_path: str, folded_path: str, schema: T.StructType, keys: Sequence[str],
             ts_col: str, order_by: Sequence[str] = ()) -> str:
    """Write the log's state as a log of one epoch (-1) at a new place, for the caller to publish."""
    state = read_upserted(spark, log_path, schema, keys, ts_col, order_by)
    state.withColumn(EPOCH_COLUMN, F.lit(-1).cast("bigint")).write.partitionBy(EPOCH_COLUMN).parquet(folded_path)
    return folded_path
