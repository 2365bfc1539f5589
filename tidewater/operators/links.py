"""Link graph: outgoing links per page and breadth-first crawl reach.

The crawl is an iterative frontier expansion: frontier ⋈ edges, minus everything already
visited (left anti joins), one round per depth. Edges and visited pages are written once, hash-bucketed
alike, so a round shuffles its frontier and what that reaches, never the stored tables; a source with
very many edges is dealt to several buckets by a salt. Each round's frontier is a table in the shared
checkpoint folder: the plan stays small and a lost executor recomputes at most one round.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import urls as U
from tidewater.functions.sizing import broadcast_if_small
from tidewater.operators.pages import page_links
from tidewater.session import materialize, shared_dir

# Edges of a source that lie together at most (about); more are dealt to several buckets.
HOT_EDGES = 1_000_000


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, pos) for every extracted link of every page."""
    return pages.select(F.col(url_col).alias("src"),
                        F.posexplode(page_links(F.col(html_col), F.col(url_col))).alias("pos", "dst"))


def links_out(pages: DataFrame, key_col: str = "page_id") -> DataFrame:
    """Number of distinct followable links per page."""
    return pages.select(key_col, F.size(page_links(F.col("html"), F.col("url"))).alias("links_out"))


class _Bucketed:
    """Tables of one walk in the shared folder, hash-bucketed alike; dropped from the catalog at its end."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.base, self.names = shared_dir(spark, "crawl"), []

    def write(self, df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
        """``df`` written in one file a bucket; a scan of it needs no exchange to join on ``keys``."""
        table = f"{name}_{uuid.uuid4().hex}"
        (df.repartition(self.buckets, *keys).write.format("parquet").option("path", f"{self.base}/{table}")
         .bucketBy(self.buckets, *keys).saveAsTable(table))
        self.names.append(table)
        return self.spark.table(table)

    def forget(self) -> None:
        """The catalog's entries go; the files stay, as those of every intermediate table."""
        for table in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")


def salted_edges(edges: DataFrame, hot_edges: int) -> tuple[DataFrame, DataFrame]:
    """(src, salt, dst) and (src, salts): the edges of a source with more than ``hot_edges`` are dealt
    to salts by a hash of their target; all others have salt 0 and are not in the second frame."""
    hot = edges.groupBy("src").agg(F.ceil(F.count(F.lit(1)) / F.lit(hot_edges)).cast("int").alias("salts")).filter("salts > 1")
    hot = materialize(hot, "crawl_hot")
    dealt = edges.join(broadcast_if_small(hot), "src", "left")
    salt = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("salts")), F.lit(0)).cast("int")
    return dealt.select("src", salt.alias("salt"), "dst"), hot


def next_frontier(frontier: DataFrame, edges: DataFrame, hot: DataFrame, visited: Sequence[DataFrame], buckets: int) -> DataFrame:
    """Unvisited targets of the frontier's edges, each once.

    ``edges`` is bucketed by (src, salt) and every table of ``visited`` by url: only the frontier
    and what it reaches move.
    """
    salts = F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1)
    asked = frontier.join(broadcast_if_small(hot.withColumnRenamed("src", "url")), "url", "left").select(
        F.col("url").alias("src"), F.explode(salts).alias("salt"))
    reached = asked.join(edges, ["src", "salt"]).select(F.col("dst").alias("url")).distinct()
    reached = reached.repartition(buckets, "url")
    for known in visited:
        reached = reached.join(known.select("url"), "url", "left_anti")
    return reached


def crawl_frontier(edges: DataFrame, seeds: DataFrame, depth_limit: int = 3,
                   max_pages: int | None = None, domains: Sequence[str] = (),
                   deny: str | None = None, hot_edges: int = HOT_EDGES, buckets: int | None = None) -> DataFrame:
    """Breadth-first reach from ``seeds`` (column ``url``) over ``edges (src, dst)``.

    Every node is visited once at its smallest depth (``<= depth_limit``). Nodes outside
    ``domains`` or matching ``deny`` are not visited. With ``max_pages`` the walk stops once
    that many pages are known, and the first in (depth, url) order are returned.
    """
    spark = edges.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    e = edges.select("src", "dst").distinct()
    if domains:
        e = e.filter(U.in_domains(F.col("dst"), domains))
    if deny:
        e = e.filter(~F.col("dst").rlike(deny))
    tables = _Bucketed(spark, buckets)
    dealt, hot = salted_edges(materialize(e, "crawl_edges"), hot_edges)
    stored = tables.write(dealt, "crawl_edges", ["src", "salt"])
    visited = [tables.write(seeds.select("url").distinct(), "crawl_depth", ["url"])]
    known = visited[0].count() if max_pages is not None else 0
    for _ in range(depth_limit):
        if max_pages is not None and known >= max_pages:
            break
        frontier = tables.write(next_frontier(visited[-1], stored, hot, visited, buckets), "crawl_depth", ["url"])
        if frontier.isEmpty():
            break
        known += frontier.count() if max_pages is not None else 0
        visited.append(frontier)
    # read by their paths: the result outlives the catalog's entries
    depths = [spark.read.schema(t.schema).parquet(f"{tables.base}/{name}").withColumn("depth", F.lit(d))
              for d, (t, name) in enumerate(zip(visited, tables.names[1:], strict=False))]
    tables.forget()
    out = reduce(DataFrame.unionByName, depths)
    return out if max_pages is None else out.orderBy("depth", "url").limit(max_pages)
