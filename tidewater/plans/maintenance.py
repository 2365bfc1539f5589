"""Schema evolution, migration, compaction and file-metadata queries."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import compact as C
from tidewater.operators import evolve as E
from tidewater.plans.registry import query
from tidewater.session import shared_dir
from tidewater.sources import evolving as EV
from tidewater.sources import published as P
from tidewater.tables import table

EVOLVE_SPLIT = "2024-01-15"
CHANGES = [
    E.AddColumn("region", "string", first=True),
    E.AddColumn("country", "string", after="user_id"),
    E.RenameColumn("event_type", "action_type"),
    E.RenameColumn("ts", "timestamp"),
    E.AddColumn("device_type", "string", comment="client device"),
    E.DropColumn("props"),
]


def evolved_events(spark, sf_dir):
    """Old rows stay in files of schema v1; new rows are written under v2; read both as v2."""
    ev = table(spark, sf_dir, "events")
    cut = F.lit(EVOLVE_SPLIT).cast("timestamp_ntz")
    v1_path, v2_path = shared_dir(spark, "evolve_v1"), shared_dir(spark, "evolve_v2")
    ev.filter(F.col("ts") < cut).write.parquet(v1_path)
    (E.evolve_schema(ev.filter(F.col("ts") >= cut), CHANGES)
     .withColumns({"region": F.lit("eu"), "country": F.lit("DE"), "device_type": F.lit("web")})
     .write.parquet(v2_path))
    v1 = spark.read.schema(ev.schema).parquet(v1_path)
    v2_schema = E.evolve_schema(ev, CHANGES).schema
    v2 = spark.read.schema(v2_schema).parquet(v2_path)
    return E.read_versions([(v1, CHANGES), (v2, [])])


_EVOLVED_SQL = f"""
SELECT NULL::VARCHAR AS region, event_id, user_id, NULL::VARCHAR AS country, event_type AS action_type,
       ts AS "timestamp", value, NULL::VARCHAR AS device_type
FROM events WHERE ts < TIMESTAMP '{EVOLVE_SPLIT}'
UNION ALL
SELECT 'eu', event_id, user_id, 'DE', event_type, ts, value, 'web'
FROM events WHERE ts >= TIMESTAMP '{EVOLVE_SPLIT}'
"""


@query("evolve_schema", _EVOLVED_SQL)
def q_evolve_schema(spark, sf_dir):
    return evolved_events(spark, sf_dir)


@query("null_backfill_count", f"""
SELECT count_if(action_type IN ('click', 'purchase') AND device_type IS NULL) AS null_rows
FROM ({_EVOLVED_SQL})
""")
def q_null_backfill_count(spark, sf_dir):
    return E.null_backfill_count(evolved_events(spark, sf_dir), "device_type", "action_type",
                                 ["click", "purchase"])


GENERATIONS = ("2024-01-10", "2024-01-20")


def evolving_events(spark, sf_dir):
    """Events appended under three schemas: in the second ``event_type`` is ``action`` and ``props`` is gone,
    in the third ``props`` is a new number and ``action`` has become ``event_type`` again."""
    ev, path = table(spark, sf_dir, "events"), shared_dir(spark, "evolving")
    first, second = (F.lit(d).cast("timestamp_ntz") for d in GENERATIONS)
    EV.create(spark, path, ev.schema)
    EV.append(ev.filter(F.col("ts") < first), path)
    EV.alter(spark, path, [E.RenameColumn("event_type", "action"), E.DropColumn("props"), E.AddColumn("device", "string", first=True)])
    EV.append(ev.filter((F.col("ts") >= first) & (F.col("ts") < second)).select(
        F.lit("web").alias("device"), "event_id", "ts", "user_id", F.col("event_type").alias("action"), "value"), path)
    EV.alter(spark, path, [E.RenameColumn("action", "event_type"), E.AddColumn("props", "int", after="event_id")])
    EV.append(ev.filter(F.col("ts") >= second).select(
        F.lit("app").alias("device"), "event_id", F.length("props").alias("props"), "ts", "user_id", "event_type", "value"), path)
    return path


@query("evolving_table", f"""
SELECT CASE WHEN ts < TIMESTAMP '{GENERATIONS[0]}' THEN NULL WHEN ts < TIMESTAMP '{GENERATIONS[1]}' THEN 'web' ELSE 'app' END AS device,
       event_id, CASE WHEN ts >= TIMESTAMP '{GENERATIONS[1]}' THEN CAST(length(props) AS INTEGER) END AS props, ts, user_id, event_type, value
FROM events""")
def q_evolving_table(spark, sf_dir):
    """Files of three schemas as one table: a renamed, a dropped and a re-added column."""
    return EV.read(spark, evolving_events(spark, sf_dir))


@query("evolving_old_version", f"""
SELECT event_id, ts, user_id, event_type AS action, value, CASE WHEN ts < TIMESTAMP '{GENERATIONS[0]}' THEN NULL ELSE 'web' END AS device
FROM events WHERE ts < TIMESTAMP '{GENERATIONS[1]}'""")
def q_evolving_old_version(spark, sf_dir):
    """The same table as it was before its third schema."""
    return EV.read(spark, evolving_events(spark, sf_dir), 4)


@query("widen_column", "SELECT * REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber) FROM lineitem")
def q_widen_column(spark, sf_dir):
    return E.widen_column(table(spark, sf_dir, "lineitem"), "l_linenumber", "bigint")


def _migrated(spark, sf_dir):
    src = table(spark, sf_dir, "orders")
    name = f"tw_orders_{uuid.uuid4().hex[:8]}"
    tgt = E.migrate_table(spark, src, name, shared_dir(spark, "migrated"), ["o_orderstatus"],
                          properties={"migrated-from": "parquet"})
    return src, tgt


@query("migrate_table", "SELECT * FROM orders")
def q_migrate_table(spark, sf_dir):
    return _migrated(spark, sf_dir)[1]


@query("validate_migration", """
WITH s AS (SELECT count(*) AS n FROM orders), b AS (SELECT count(*) AS n FROM orders WHERE o_orderkey % 10 <> 0)
SELECT 'same' AS kind, n AS source_rows, n AS target_rows, TRUE AS schema_match, TRUE AS checksum_match, TRUE AS valid FROM s
UNION ALL SELECT 'rows lost', s.n, b.n, TRUE, s.n = b.n, s.n = b.n FROM s, b
UNION ALL SELECT 'value changed', n, n, TRUE, n = 0, n = 0 FROM s
UNION ALL SELECT 'column missing', n, n, FALSE, FALSE, FALSE FROM s
""")
def q_validate_migration(spark, sf_dir):
    """A migrated table, and the same with rows lost, a value changed and a column missing. The
    source carries a map column."""
    src, tgt = _migrated(spark, sf_dir)
    tag = lambda df: df.withColumn("tags", F.create_map(F.lit("priority"), F.col("o_orderpriority")))
    cases = {"same": tag(tgt), "rows lost": tag(tgt.filter(F.col("o_orderkey") % 10 != 0)),
             "value changed": tag(tgt).withColumn("tags", F.map_concat("tags", F.create_map(F.lit("late"), F.lit("x")))),
             "column missing": tag(tgt).drop("o_totalprice")}
    out = None
    for kind, target in cases.items():
        row = E.validate_migration(tag(src), target).select(F.lit(kind).alias("kind"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def small_file_events(spark, sf_dir):
    """Events written as many small files per event type (the compaction input)."""
    ev = table(spark, sf_dir, "events")
    path = shared_dir(spark, "small_files")
    ev.repartition(32).write.partitionBy("event_type").parquet(path)
    return ev, path


def compacted_events(spark, sf_dir):
    """Events published in many small files, half of them by a second append, then compacted."""
    ev, path = table(spark, sf_dir, "events"), shared_dir(spark, "published")
    for parity in (0, 1):
        P.publish(ev.filter(F.col("event_id") % 2 == parity).repartition(16), path, ["event_type"])
    C.compact_table(spark, path, target_bytes=1024 * 1024)
    return ev, path


@query("compact_table", "SELECT * FROM events")
def q_compact_table(spark, sf_dir):
    return P.read_published(spark, compacted_events(spark, sf_dir)[1])


@query("published_history", """
SELECT version, operation, n AS rows, version = 3 AS fewer_files FROM (
  SELECT 1 AS version, 'append' AS operation, count(*) FILTER (event_id % 2 = 0) AS n FROM events
  UNION ALL SELECT 2, 'append', count(*) FROM events
  UNION ALL SELECT 3, 'compact', count(*) FROM events)""")
def q_published_history(spark, sf_dir):
    """The published versions of the compacted table; only the compaction has fewer files than the one before."""
    w = Window.orderBy("version")  # one row a version
    seen = P.history(spark, compacted_events(spark, sf_dir)[1])
    fewer = F.coalesce(F.col("files") < F.lag("files").over(w), F.lit(False))
    return seen.select("version", "operation", "rows", fewer.alias("fewer_files"))


PLAN_TARGET, PLAN_MIN_FILES = 400, 2


@query("compaction_plan", f"""
WITH RECURSIVE
files AS (SELECT event_type, CAST(user_id AS VARCHAR) AS file, CAST(sum(strlen(props)) AS BIGINT) AS size
          FROM events GROUP BY event_type, user_id),
ordered AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY size DESC, file) AS k FROM files WHERE size < {PLAN_TARGET}),
packing AS (
  SELECT DISTINCT event_type, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS fill, CAST(-1 AS BIGINT) AS bin, CAST(0 AS BIGINT) AS size FROM files
  UNION ALL
  SELECT event_type, k, CASE WHEN place IS NULL THEN list_append(fill, size)
                             ELSE list_transform(fill, lambda f, i: CASE WHEN i = place THEN f + size ELSE f END) END,
         coalesce(place, len(fill) + 1) - 1, size
  FROM (SELECT p.event_type, o.k, o.size, p.fill,
               list_position(p.fill, list_max(list_filter(p.fill, lambda f: f + o.size <= {PLAN_TARGET}))) AS place
        FROM packing p JOIN ordered o ON o.event_type = p.event_type AND o.k = p.k + 1))
SELECT event_type, bin, count(*) AS input_files, CAST(sum(size) AS BIGINT) AS input_bytes
FROM packing WHERE k > 0 GROUP BY event_type, bin HAVING count(*) >= {PLAN_MIN_FILES}
""")
def q_compaction_plan(spark, sf_dir):
    """Best fit by falling size. The files are stood in for by the bytes of each user's events of a type."""
    stats = table(spark, sf_dir, "events").groupBy("event_type", F.col("user_id").cast("string").alias("file_path")).agg(
        F.sum(F.octet_length("props")).alias("file_size"))
    plan = C.compaction_plan(stats, ["event_type"], target_bytes=PLAN_TARGET, min_input_files=PLAN_MIN_FILES)
    return plan.select("event_type", "bin", "input_files", "input_bytes")


@query("compaction_integrity", """
SELECT event_type, count(*) AS rows_before, round(avg(value), 2) AS avg_before,
       count(*) - count_if(event_type = 'click' AND event_id % 3 = 0) AS rows_after,
       round(avg(value) FILTER (event_type <> 'click' OR event_id % 3 <> 0), 2) AS avg_after,
       event_type <> 'click' OR count_if(event_id % 3 = 0) = 0 AS match
FROM events GROUP BY event_type
""")
def q_compaction_integrity(spark, sf_dir):
    """The compacted table compared with its source, after a third of one partition was lost."""
    ev, path = compacted_events(spark, sf_dir)
    after = P.read_published(spark, path)
    lost = (F.col("event_type") == "click") & (F.col("event_id") % 3 == 0)
    return C.compaction_integrity(ev, after.filter(~lost), "event_type", "value")


def _small_stats(spark, sf_dir):
    ev, path = small_file_events(spark, sf_dir)
    return C.file_stats(spark.read.schema(ev.schema).parquet(path), ["event_type"])


@query("file_stats", "SELECT event_type, count(*) AS record_count FROM events GROUP BY event_type")
def q_file_stats(spark, sf_dir):
    """Records per partition, summed over the files' own counts."""
    return _small_stats(spark, sf_dir).groupBy("event_type").agg(F.sum("record_count").alias("record_count"))


@query("file_distribution", """
SELECT event_type, count(*) AS record_count, TRUE AS sizes_agree FROM events GROUP BY event_type""")
def q_file_distribution(spark, sf_dir):
    d = C.file_distribution(_small_stats(spark, sf_dir), ["event_type"])
    agree = F.abs(F.col("avg_file_bytes") * F.col("file_count") - F.col("total_bytes")) <= F.col("file_count")
    return d.select("event_type", "record_count", agree.alias("sizes_agree"))


@query("largest_files")
def q_largest_files(spark, sf_dir):
    return C.largest_files(_small_stats(spark, sf_dir), 10)


@query("file_totals", "SELECT (SELECT count(*) FROM events) > 0 AS has_bytes, count(*) AS empty_files FROM events WHERE FALSE")
def q_file_totals(spark, sf_dir):
    """Totals of the table's files, and of no files at all (0, not NULL)."""
    stats = _small_stats(spark, sf_dir)
    none = C.file_totals(stats.filter(F.lit(False))).select(F.col("total_bytes").alias("empty_files"))
    return C.file_totals(stats).select((F.col("total_bytes") > 0).alias("has_bytes"),
                                       none.scalar().cast("bigint").alias("empty_files"))


@query("nested_projection", """
SELECT c_custkey, c_name, n_name AS nation_name, n_regionkey AS nation_region,
       c_mktsegment AS segment, CAST(c_acctbal AS VARCHAR) AS balance_text
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def q_nested_projection(spark, sf_dir):
    """Struct and map columns built from customer ⋈ nation, then read back by field/key."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    nested = c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey", "c_name",
        F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")).alias("nation"),
        F.create_map(F.lit("segment"), F.col("c_mktsegment"),
                     F.lit("balance"), F.col("c_acctbal").cast("string")).alias("attrs"),
    )
    return nested.select(
        "c_custkey", "c_name",
        F.col("nation.name").alias("nation_name"), F.col("nation.region").alias("nation_region"),
        F.col("attrs").getItem("segment").alias("segment"),
        F.col("attrs")["balance"].alias("balance_text"),
    )
