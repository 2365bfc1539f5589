"""Approximate nearest neighbours by HNSW graphs (operator 10).

Vectors are dealt into shards. Each shard gets a hierarchical navigable small-world graph, stored
as flat arrays (vectors, bottom-layer neighbours, upper layers), one table row a shard. Queries go
to every shard, search its graph, and the shards' results are merged per query.

Equal vectors are one node that carries its smallest ids, so a vector with thousands of copies
neither floods a graph nor crowds out the others. The graph is searched in single precision;
what it finds is scored in double precision on the original vectors.

Scale: a shard has about ``SHARD_NODES`` nodes, so building is a bounded task; the index is
written as a table and can be kept. To search, a shard is one task's: shuffled once, it stands before
its queries, which are streamed past it; all shards are searched. A shard returns ``k`` rows a query,
and a window with a partial limit merges them.

Defined results: rows whose id is null, or whose vector is null, empty, zero or holds null or
non-finite components, take no part; vectors of different length are not comparable; rows that
repeat an id and vector are one; a query with fewer than k candidates gets them all; ties go to
the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.scratch import Scratch
from tidewater.tables import table

SHARD_NODES = 8192
LINKS = 16  # of a node in the upper layers; twice as many in the bottom layer
BUILD_BEAM = 64
SEARCH_BEAM = 96
K = 5


class Hnsw:
    """A graph over unit vectors; neighbours in flat arrays, -1 where there is none."""

    def __init__(self, vectors: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM):
        self.vectors = np.ascontiguousarray(vectors, np.float32)
        self.links, self.beam = links, beam
        n = len(vectors)
        self.width = [2 * links]  # neighbours a node may have, by layer
        self.layers: list[np.ndarray] = [np.full((n, 2 * links), -1, np.int32)]
        self.degree: list[np.ndarray] = [np.zeros(n, np.int32)]
        self.entry, self.top = -1, -1
        self.seen, self.mark = np.zeros(n, np.int64), 0

    @classmethod
    def build(cls, vectors: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM, seed: int = 7) -> Hnsw:
        graph = cls(vectors, links, beam)
        rng = np.random.default_rng(seed)
        heights = np.floor(-np.log(rng.random(len(vectors)) + 1e-12) / np.log(links)).astype(int)
        for node, height in enumerate(heights.tolist()):
            graph._insert(node, height)
        return graph

    def _neighbours(self, node: int, layer: int) -> np.ndarray:
        return self.layers[layer][node, :self.degree[layer][node]]

    def _search_layer(self, query: np.ndarray, starts: list[tuple[float, int]], beam: int, layer: int) -> list[tuple[float, int]]:
        """The ``beam`` most similar nodes found from ``starts``, as (similarity, node)."""
        self.mark += 1
        mark, seen, vectors = self.mark, self.seen, self.vectors
        links, degree = self.layers[layer], self.degree[layer]
        for _, node in starts:
            seen[node] = mark
        ahead = [(-s, node) for s, node in starts]
        best = list(starts)
        heapq.heapify(ahead)
        heapq.heapify(best)
        while ahead:
            s, node = heapq.heappop(ahead)
            if len(best) >= beam and -s < best[0][0]:
                break
            near = links[node, :degree[node]]
            near = near[seen[near] != mark]
            if not len(near):
                continue
            seen[near] = mark
            for sim, other in zip((vectors[near] @ query).tolist(), near.tolist(), strict=True):
                if len(best) < beam:
                    heapq.heappush(best, (sim, other))
                    heapq.heappush(ahead, (-sim, other))
                elif sim > best[0][0]:
                    heapq.heapreplace(best, (sim, other))
                    heapq.heappush(ahead, (-sim, other))
        return best

    def _spread(self, nodes: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Nodes by falling similarity, leaving out those closer to one already taken; then filled up."""
        order = np.argsort(-sims, kind="stable")
        nodes, sims = nodes[order], sims[order]
        between = self.vectors[nodes] @ self.vectors[nodes].T
        covered = np.full(len(nodes), -2.0, np.float32)
        taken: list[int] = []
        for i in range(len(nodes)):
            if covered[i] < sims[i]:
                taken.append(i)
                if len(taken) == most:
                    break
                np.maximum(covered, between[i], out=covered)
        if len(taken) < most:
            rest = np.setdiff1d(np.arange(len(nodes)), taken)
            taken += rest[:most - len(taken)].tolist()
        return nodes[taken]

    def _insert(self, node: int, height: int) -> None:
        n = len(self.vectors)
        while len(self.layers) <= height:
            self.width.append(self.links)
            self.layers.append(np.full((n, self.links), -1, np.int32))
            self.degree.append(np.zeros(n, np.int32))
        query = self.vectors[node]
        if self.entry < 0:
            self.entry, self.top = node, height
            return
        starts = [(float(self.vectors[self.entry] @ query), self.entry)]
        for layer in range(self.top, height, -1):
            starts = [max(self._search_layer(query, starts, 1, layer))]
        for layer in range(min(height, self.top), -1, -1):
            starts = self._search_layer(query, starts, self.beam, layer)
            found = np.array([x for _, x in starts], np.int32)
            chosen = self._spread(found, np.array([s for s, _ in starts], np.float32), self.links)
            self.layers[layer][node, :len(chosen)] = chosen
            self.degree[layer][node] = len(chosen)
            for other in chosen.tolist():
                d = self.degree[layer][other]
                if d < self.width[layer]:
                    self.layers[layer][other, d] = node
                    self.degree[layer][other] = d + 1
                else:  # a full list is thinned to three quarters
                    all_near = np.append(self.layers[layer][other], node).astype(np.int32)
                    kept = self._spread(all_near, self.vectors[all_near] @ self.vectors[other], 3 * self.width[layer] // 4)
                    self.layers[layer][other] = -1
                    self.layers[layer][other, :len(kept)] = kept
                    self.degree[layer][other] = len(kept)
        if height > self.top:
            self.entry, self.top = node, height

    def search(self, query: np.ndarray, k: int, beam: int = SEARCH_BEAM) -> list[int]:
        """At least the k most similar nodes that the beam finds."""
        if self.entry < 0:
            return []
        query = np.asarray(query, np.float32)
        starts = [(float(self.vectors[self.entry] @ query), self.entry)]
        for layer in range(self.top, 0, -1):
            starts = [max(self._search_layer(query, starts, 1, layer))]
        return [node for _, node in self._search_layer(query, starts, max(beam, k), 0)]

    # -- as flat arrays
    def stored(self) -> dict:
        upper = [np.nonzero(d)[0].astype(np.int32) for d in self.degree[1:]]
        return {"entry": self.entry, "top": self.top, "links": self.links, "bottom": self.layers[0].tobytes(),
                "upper_nodes": [u.tobytes() for u in upper],
                "upper_links": [layer[u].tobytes() for layer, u in zip(self.layers[1:], upper, strict=True)]}

    @classmethod
    def restored(cls, vectors: np.ndarray, row: dict) -> Hnsw:
        graph = cls(vectors, row["links"])
        n = len(vectors)
        graph.layers = [np.frombuffer(row["bottom"], np.int32).reshape(n, 2 * row["links"])]
        for nodes, links in zip(row["upper_nodes"], row["upper_links"], strict=True):
            at = np.frombuffer(nodes, np.int32)
            layer = np.full((n, row["links"]), -1, np.int32)
            layer[at] = np.frombuffer(links, np.int32).reshape(len(at), row["links"])
            graph.layers.append(layer)
        graph.degree = [(layer >= 0).sum(axis=1).astype(np.int32) for layer in graph.layers]
        graph.entry, graph.top = row["entry"], row["top"]
        return graph


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; by the largest component first, so no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


_INDEX = ("dim int, shard int, vectors binary, ids binary, id_counts binary, entry int, top int, links int, bottom binary, "
          "upper_nodes array<binary>, upper_links array<binary>")


def build_index(nodes: DataFrame, scratch: Scratch, shard_nodes: int = SHARD_NODES, links: int = LINKS,
                beam: int = BUILD_BEAM) -> DataFrame:
    """One row a shard, from nodes (dim, vector, ids) with one row per distinct vector."""
    counts = nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    shards = F.greatest(F.ceil(F.col("n") / shard_nodes), F.lit(1))
    sized = scratch.save(counts.select(F.col("dim").alias("of_dim"), shards.cast("int").alias("shards")), "shards")
    dealt = nodes.join(sized, F.col("dim") == F.col("of_dim")).select(
        "dim", F.pmod(F.xxhash64(F.element_at("ids", 1)), F.col("shards")).cast("int").alias("shard"), "vector", "ids")

    def build(key: tuple, group: pa.Table) -> pa.Table:
        rows = group.select(["vector", "ids"]).to_pylist()
        rows.sort(key=lambda r: r["ids"][0])
        vectors = np.array([r["vector"] for r in rows], np.float64)
        graph = Hnsw.build(unit(vectors), links, beam).stored()
        ids = np.array([i for r in rows for i in r["ids"]], np.int64)
        counts = np.array([len(r["ids"]) for r in rows], np.int32)
        row = {"dim": key[0].as_py(), "shard": key[1].as_py(), "vectors": vectors.tobytes(), "ids": ids.tobytes(),
               "id_counts": counts.tobytes()} | graph
        return pa.Table.from_pylist([row], schema=pa.schema([
            ("dim", pa.int32()), ("shard", pa.int32()), ("vectors", pa.binary()), ("ids", pa.binary()), ("id_counts", pa.binary()),
            ("entry", pa.int32()), ("top", pa.int32()), ("links", pa.int32()), ("bottom", pa.binary()),
            ("upper_nodes", pa.list_(pa.binary())), ("upper_links", pa.list_(pa.binary()))]))

    return scratch.save(dealt.groupBy("dim", "shard").applyInArrow(build, _INDEX), "index")


def search_index(index: DataFrame, queries: DataFrame, k: int = K, beam: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, vec_id, score): each shard's best ``k`` other ids for every query (query_id, vector).

    All shards of a query's width are searched. A shard is one task's: it is shuffled once, stands
    before its queries, and these are streamed past it, however many there are.
    """
    shards = index.select(F.col("dim").alias("of_dim"), F.col("shard").alias("to_shard"))
    asked = queries.withColumn("dim", F.size("vector")).join(shards, F.col("dim") == F.col("of_dim")).select(
        "dim", F.col("to_shard").alias("shard"), F.lit(1).alias("side"), "query_id", "vector")
    stored = index.withColumn("side", F.lit(0))
    both = stored.unionByName(asked, allowMissingColumns=True)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, graph = None, None
        for batch in batches:
            out: list[tuple[int, int, float]] = []
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                if row["side"] == 0:
                    at = (row["dim"], row["shard"])
                    vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"])
                    graph = Hnsw.restored(unit(vectors), row)
                    counts = np.frombuffer(row["id_counts"], np.int32)
                    ends, ids = np.cumsum(counts), np.frombuffer(row["ids"], np.int64)
                elif at == (row["dim"], row["shard"]):
                    q = np.array([row["vector"]], np.float64)
                    found = np.array(graph.search(unit(q)[0], k + 1, beam))
                    scores = _cosine(vectors[found], q[0])
                    best = []
                    for s, node in sorted(zip((-scores).tolist(), found.tolist(), strict=True))[:k + 1]:
                        best += [(s, int(i)) for i in ids[ends[node] - counts[node]:ends[node]] if i != row["query_id"]]
                    out += [(row["query_id"], i, -s) for s, i in sorted(best)[:k]]
            cols = list(zip(*out, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())],
                                             ["query_id", "vec_id", "score"])

    dealt = both.repartition("dim", "shard").sortWithinPartitions("dim", "shard", "side")
    return dealt.mapInArrow(search, "query_id bigint, vec_id bigint, score double")


def _cosine(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosines in double precision; scaled first where squares could leave the range."""
    largest = max(float(np.abs(vectors).max()), float(np.abs(query).max()))
    if largest > 1e100 or largest < 1e-100:
        vectors, query = unit(vectors), unit(query[None, :])[0]
    return (vectors @ query) / (np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt(query @ query))


def nearest(vectors: DataFrame, queries: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
            shard_nodes: int = SHARD_NODES, links: int = LINKS, build_beam: int = BUILD_BEAM,
            search_beam: int = SEARCH_BEAM) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of ``vectors`` where ``queries`` holds, against all rows."""
    scratch = Scratch(vectors.sparkSession, "neighbours")
    rows = (vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
            .select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"),
                    F.coalesce(queries, F.lit(False)).alias("asks")).distinct())
    rows = scratch.save(rows, "vectors")
    # a vector's smallest k + 1 ids answer any query: at most one of them is the query's own
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.select("vec_id", "vector").distinct().withColumn("place", place).where(F.col("place") <= k + 1)
    nodes = scratch.save(few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
                         .select(F.size("vector").alias("dim"), "vector", "ids"), "nodes")
    index = build_index(nodes, scratch, shard_nodes, links, build_beam)
    asked = rows.where("asks").select(F.col("vec_id").alias("query_id"), "vector")
    found = search_index(index, asked, k, search_beam)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
