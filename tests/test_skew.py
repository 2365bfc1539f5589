"""Hot keys: one key holding about a third of all rows."""

import duckdb
from pyspark.sql import functions as F

from tidewater.operators import compact as C
from tidewater.sources import published as P
from tidewater.operators import dedup as D

SF = "/root/testdata/sf0.01"


def skewed_lineitem(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    hot = (F.col("l_orderkey") % 3) == 0   # rule that sends a third of the rows to one key
    return li.withColumn("l_orderkey", F.when(hot, F.lit(0)).otherwise(F.col("l_orderkey")))


def test_dedup_with_hot_key_matches_duckdb(spark):
    out = D.dedup_lww(skewed_lineitem(spark), ["l_orderkey", "l_linenumber"], "l_shipdate",
                      ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    got = sorted(tuple(r) for r in out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").collect())
    want = duckdb.sql(f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
          SELECT *, row_number() OVER (PARTITION BY k, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
                                       l_partkey, l_suppkey, l_quantity, l_extendedprice) rn
          FROM (SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS l_orderkey),
                       CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS k
                FROM read_parquet('{SF}/lineitem.parquet'))) WHERE rn = 1""").fetchall()
    assert got == sorted(want)


def test_hot_partition_is_split_across_files(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn(
        "part", F.when(F.col("event_type").isin("click", "view"), "hot").otherwise(F.col("event_type")))
    path = tmp_dir + "/table"
    P.publish(ev.repartition(20), path, ["part"])
    made = C.compact_table(spark, path, target_bytes=64 * 1024)
    files = P.live_files(spark, path, made).groupBy("partition.part").count()
    per = {r.part: r["count"] for r in files.collect()}
    assert per["hot"] > 1 and per["hot"] >= max(v for k, v in per.items() if k != "hot")
    assert P.read_published(spark, path).count() == ev.count()
