"""A stored vector index: chunks in lists of similar direction, kept as published Parquet tables.

    centers   one row a list: its unit vector                       written when the index is built
    lists     per append and list: rows and the widest angle        tells radii and sizes, a row a list
    rows      the chunks with ``list_id`` and ``angle``, partitioned by list_id

Lists are fitted once, on a bounded sample; a chunk appended later goes to the nearest list, so
appending costs one pass over what is appended. Every step is published (``sources.published``): an
interrupted append leaves the index as it was.

``search`` probes the lists nearest to each query. ``search_exact`` reads a list only if it can hold
one of a query's best k: by the triangle inequality on angles, no vector of a list is nearer to the
query than the angle to the list's center less the list's radius, and what cannot reach the k-th
score found so far is left out. Either way queries travel to the blocks of the lists that they
probe; chunks are shuffled once, unrepeated, and folders of lists that no query probes are not read.
A task holds one block of chunks and streams the queries past it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import materialize
from tidewater.sources.published import publish, read_published

# Retrieval defaults (top-k, score floor, IVF lists).
DEFAULT_TOP_K = 5
DEFAULT_MIN_SCORE = 0.65
DEFAULT_LISTS = 100

# Rows that the lists are fitted on at most; every row is assigned to a list.
IVF_FIT_ROWS = 20_000
# Numbers in the chunks of a list that one task holds (8 bytes each): a query is sent once to every block of
# the lists that it probes, so blocks are as large as memory allows. Lists that an exact search reads before it prunes.
BLOCK_CELLS = 1 << 21
FIRST_PROBES = 2
# Scores that a task holds at a time at most (8 bytes each): queries are scored in slices that keep to it.
SCORE_CELLS = 1 << 20
NO_LIST = -1
# Scores are compared with this slack, more than products of unit vectors can be off.
SLACK = 1e-9


@dataclass(frozen=True)
class Index:
    """An opened index; ``centers``, ``radius`` and ``sizes`` have one entry a list."""

    path: str
    chunk_id: str
    emb: str
    centers: np.ndarray
    radius: np.ndarray
    sizes: np.ndarray

    def rows(self, spark: SparkSession) -> DataFrame:
        return read_published(spark, f"{self.path}/rows")


def unit_rows(vectors: Sequence, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(positions, unit vectors) of those vectors that have a direction: finite, not zero, of one width."""
    at, out = [], []
    for i, v in enumerate(vectors):
        if v is None or len(v) == 0 or (width is not None and len(v) != width):
            continue
        x = np.asarray(v, dtype=np.float64)
        norm = np.linalg.norm(x)
        if np.isfinite(norm) and norm > 0:
            width = len(x)
            at.append(i)
            out.append(x / norm)
    return np.array(at, dtype=np.int64), np.stack(out) if out else np.zeros((0, width or 0))


def _angles(units: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centers.T, -1.0, 1.0))


def has_direction(emb: str) -> Column:
    """Not null or empty, all components finite, not all zero."""
    finite = F.forall(F.col(emb), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce((F.size(emb) > 0) & finite & F.exists(F.col(emb), lambda x: x != 0), F.lit(False))


def fit_centers(chunks: DataFrame, chunk_id: str, emb: str, lists: int, seed: int = 42, max_iter: int = 20,
                fit_rows: int = IVF_FIT_ROWS) -> np.ndarray:
    """Unit vectors of at most ``lists`` lists: k-means (cosine) on at most ``fit_rows`` chunks, chosen
    by a hash of the id and written once, so its passes do not repeat the plan above them."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    usable = chunks.where(has_direction(emb)).select(chunk_id, emb)
    sample = materialize(usable.orderBy(F.xxhash64(F.col(chunk_id)), chunk_id).limit(fit_rows).select(emb), "ivf_sample")
    first = sample.first()
    if first is None:
        return np.zeros((0, 0))
    fit = sample.select(array_to_vector(F.col(emb).cast("array<double>")).alias("features"))
    model = KMeans(k=max(2, lists), seed=seed, maxIter=max_iter, distanceMeasure="cosine").fit(fit)
    return unit_rows(model.clusterCenters())[1]


def with_lists(chunks: DataFrame, emb: str, centers: np.ndarray) -> DataFrame:
    """``chunks`` with ``list_id`` (the nearest center, -1 for vectors without a direction) and ``angle``."""
    shared = chunks.sparkSession.sparkContext.broadcast(centers)  # lists x width numbers

    @F.pandas_udf("list_id int, angle double")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        at, units = unit_rows(vectors, shared.value.shape[1])
        out = pd.DataFrame({"list_id": np.full(len(vectors), NO_LIST, np.int32), "angle": np.zeros(len(vectors))})
        if len(at) and len(shared.value):
            angles = _angles(units, shared.value)
            best = angles.argmin(1)
            out.loc[at, "list_id"] = best.astype(np.int32)
            out.loc[at, "angle"] = angles[np.arange(len(at)), best]
        return out

    return chunks.withColumn("_list", nearest(F.col(emb))).select(*chunks.columns, "_list.list_id", "_list.angle")


def _append(chunks: DataFrame, path: str, emb: str, centers: np.ndarray) -> None:
    assigned = materialize(with_lists(chunks, emb, centers), "ivf_assigned")
    # radii first: should the rows not follow, the lists are only thought wider than they are
    publish(assigned.groupBy("list_id").agg(F.count(F.lit(1)).alias("rows"), F.max("angle").alias("radius")), f"{path}/lists")
    publish(assigned.repartition("list_id"), f"{path}/rows", ["list_id"])


def build_index(chunks: DataFrame, path: str, chunk_id: str = "id", emb: str = "embedding", lists: int = DEFAULT_LISTS,
                seed: int = 42, max_iter: int = 20, fit_rows: int = IVF_FIT_ROWS) -> Index:
    """Fit lists on ``chunks`` and store them, with all their columns, at ``path``."""
    clash = sorted({c.lower() for c in chunks.columns} & {"list_id", "angle", "gen"})
    if clash:
        raise ValueError(f"columns {clash} are the index's own")
    spark = chunks.sparkSession
    centers = fit_centers(chunks, chunk_id, emb, lists, seed, max_iter, fit_rows)
    rows = [(i, [float(x) for x in c], chunk_id, emb) for i, c in enumerate(centers)] or [(NO_LIST, [], chunk_id, emb)]
    publish(spark.createDataFrame(rows, "list_id int, center array<double>, chunk_id string, emb string"), f"{path}/centers")
    _append(chunks, path, emb, centers)
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> Index:
    """The index at ``path``: its centers and, summed over all appends, its radii and sizes (a row a list)."""
    rows = read_published(spark, f"{path}/centers").orderBy("list_id").collect()
    vectors = [r["center"] for r in rows if r["list_id"] != NO_LIST]
    centers = np.array(vectors, dtype=np.float64) if vectors else np.zeros((0, 0))
    radius, sizes = np.zeros(len(centers)), np.zeros(len(centers), np.int64)
    known = read_published(spark, f"{path}/lists").groupBy("list_id").agg(F.max("radius").alias("radius"), F.sum("rows").alias("rows"))
    for r in known.where(F.col("list_id") != NO_LIST).collect():
        radius[r["list_id"]], sizes[r["list_id"]] = r["radius"], r["rows"]
    return Index(path, rows[0]["chunk_id"], rows[0]["emb"], centers, radius, sizes)


def append_to_index(chunks: DataFrame, index: Index) -> Index:
    """Assign ``chunks`` to the stored lists and publish them as one more version; opens the result."""
    _append(chunks, index.path, index.emb, index.centers)
    return open_index(chunks.sparkSession, index.path)


# ---- search ------------------------------------------------------------------------------------

Choice = Callable[[np.ndarray, np.ndarray], list[np.ndarray]]


def _routes(queries: DataFrame, index: Index, choose: Choice) -> DataFrame:
    """(query, _emb, _k, list_id): each query once per list that ``choose`` names, written once.

    ``choose`` gets the angles to all centers (a row a query) and the queries' present floors. A query
    is written with the array of its lists, and repeated only when that is read.
    """
    shared = queries.sparkSession.sparkContext.broadcast(index.centers)
    names = queries.columns
    schema = T.StructType([*[f for f in queries.schema.fields if f.name != "_floor"], T.StructField("_lists", T.ArrayType(T.IntegerType()))])

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at, units = unit_rows(batch["_emb"], shared.value.shape[1])
            if not len(at) or not len(shared.value):
                continue
            floors = batch["_floor"].to_numpy()[at] if "_floor" in names else np.zeros(len(at))
            chosen = choose(_angles(units, shared.value), floors)
            out = batch.iloc[at].drop(columns="_floor", errors="ignore")
            yield out.assign(_lists=pd.Series([c.astype(np.int32) for c in chosen], index=out.index, dtype=object))

    routes = materialize(queries.mapInPandas(route, schema), "ivf_routes")
    return routes.withColumn("list_id", F.explode("_lists")).drop("_lists")


def best_of(scores: np.ndarray, k: int, floor: float) -> np.ndarray:
    """Positions that may be among the best ``k``: ties with the k-th are kept for the final merge."""
    hit = np.nonzero(scores >= floor)[0]
    if len(hit) > k:
        kth = np.partition(scores[hit], len(hit) - k)[len(hit) - k]
        hit = hit[scores[hit] >= kth - SLACK]
    return hit


def best_pairs(asked: np.ndarray, ks: Sequence[int], units: np.ndarray, floor: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(positions in ``asked``, positions in ``units``, scores) of what ``best_of`` keeps, a slice of queries at a time."""
    step = max(1, SCORE_CELLS // max(1, len(units)))
    for lo in range(0, len(asked), step):
        scores = asked[lo:lo + step] @ units.T
        np.minimum(scores, 1.0, out=scores)
        found = [best_of(s, k, floor) for s, k in zip(scores, ks[lo:lo + step], strict=True)]
        again = np.repeat(np.arange(len(found)), [len(f) for f in found])
        if len(again):
            hits = np.concatenate(found)
            yield lo + again, hits, scores[again, hits]


def list_blocks(index: Index, block_rows: int | None = None) -> list[int]:
    """Blocks of each list: of at most ``block_rows`` chunks on average, or of what ``BLOCK_CELLS`` holds at their width."""
    rows = block_rows or max(1, BLOCK_CELLS // max(1, *index.centers.shape[1:]))
    return [int(max(1, -(-n // rows))) for n in index.sizes]


def _candidates(routes: DataFrame, index: Index, query_id: str, min_score: float, block_rows: int | None) -> DataFrame:
    """(query, chunk, score): for every routed query and each block of its lists, the block's best."""
    spark, cid = routes.sparkSession, index.chunk_id
    blocks = F.get(F.array(*[F.lit(n) for n in list_blocks(index, block_rows)] or [F.lit(1)]), F.col("list_id"))
    # at most as many numbers as the index has lists; other lists' folders are not read
    probed = [r["list_id"] for r in routes.select("list_id").distinct().collect()]
    chunk = index.rows(spark).select(F.col(cid).alias("_cid"), F.col(index.emb).alias("_emb"), "list_id")
    if chunk.schema["_emb"].dataType != routes.schema["_emb"].dataType:  # else they are widened where they are scored
        chunk, routes = (side.withColumn("_emb", F.col("_emb").cast("array<double>")) for side in (chunk, routes))
    chunk = chunk.where(F.col("list_id").isin(probed)).withColumn("_sub", F.pmod(F.xxhash64("_cid"), blocks).cast("int"))
    routed = routes.withColumn("_sub", F.explode(F.sequence(F.lit(0), blocks - 1)))
    kinds = {"_cid": dict(chunk.dtypes)["_cid"], "_qid": dict(routes.dtypes)[query_id]}
    nothing = lambda name: F.lit(None).cast(kinds[name]).alias(name)
    both = chunk.select("list_id", "_sub", F.lit(0).alias("_side"), "_cid", nothing("_qid"), "_emb", F.lit(0).alias("_k")).unionByName(
        routed.select("list_id", "_sub", F.lit(1).alias("_side"), nothing("_cid"), F.col(query_id).alias("_qid"),
                      "_emb", "_k"))
    schema = T.StructType([routes.schema[query_id], T.StructField(cid, chunk.schema["_cid"].dataType),
                           T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, ids, vectors, units = None, [], [], None
        for batch in batches:
            for key, part in batch.groupby(["list_id", "_sub"], sort=False):
                if key != block:
                    block, ids, vectors, units = key, [], [], None
                chunks, queries = part[part["_side"] == 0], part[part["_side"] == 1]
                ids += chunks["_cid"].tolist()
                vectors += chunks["_emb"].tolist()
                if not len(queries) or not vectors:
                    continue
                if units is None:  # a block's chunks come before its queries
                    at, units = unit_rows(vectors)
                    names = np.array(ids, dtype=object)[at]
                at, asked = unit_rows(queries["_emb"], units.shape[1])
                qids, ks = queries["_qid"].to_numpy()[at], queries["_k"].to_numpy()[at].tolist()
                for again, hits, scores in best_pairs(asked, ks, units, min_score):
                    yield pd.DataFrame({query_id: qids[again], cid: names[hits], "score": scores})

    together = both.repartition("list_id", "_sub").sortWithinPartitions("list_id", "_sub", "_side")
    return together.mapInPandas(score, schema)


def top_k(candidates: DataFrame, k: DataFrame | Column, query_id: str, chunk_id: str, tie_cols: Sequence[str] = ()) -> DataFrame:
    """Each query's best k candidates: (query, chunk, rank, score). ``k`` is a column, or (query, _k) rows.

    Scores that agree to 12 digits are ties, which go by ``tie_cols`` and the chunk's id.
    """
    ties = [c for c in tie_cols if c != chunk_id] + [chunk_id]
    if isinstance(k, DataFrame):
        candidates, k = candidates.join(k, query_id), F.col("_k")
    w = Window.partitionBy(query_id).orderBy(F.round("score", 12).desc(), *[F.col(c).asc() for c in ties])
    ranked = candidates.withColumn("rank", F.row_number().over(w))
    return ranked.filter(F.col("rank") <= k).select(query_id, chunk_id, F.col("rank").cast("int").alias("rank"),
                                                    F.round("score", 6).alias("score"))


def effective_k(k: int | str | None, default: int = DEFAULT_TOP_K) -> Column:
    """A constant or per-query k; null and what is below 1 mean the default."""
    col = F.col(k) if isinstance(k, str) else F.lit(k)
    return F.when(col > 0, col).otherwise(F.lit(default)).cast("int")


def _prepared(queries: DataFrame, query_id: str, q_emb: str, k: int | str | None) -> DataFrame:
    return queries.select(query_id, F.col(q_emb).alias("_emb"), effective_k(k).alias("_k"))


def search(queries: DataFrame, index: Index, query_id: str = "query_id", q_emb: str = "embedding", k: int | str | None = None,
           min_score: float | None = None, probes: int = 10, block_rows: int | None = None) -> DataFrame:
    """Approximate top-k (query, chunk, rank, score): the ``probes`` nearest lists of each query, exactly scored.

    Query ids are unique; vectors without a direction find nothing and are not found.
    """
    floor = DEFAULT_MIN_SCORE if min_score is None else min_score
    q = _prepared(queries, query_id, q_emb, k)
    routes = _routes(q, index, lambda angles, _: list(np.argsort(angles, axis=1, kind="stable")[:, :probes]))
    found = _candidates(routes, index, query_id, floor, block_rows)
    return top_k(found, q.select(query_id, "_k"), query_id, index.chunk_id)


def exact_routes(queries: DataFrame, index: Index, query_id: str, min_score: float, block_rows: int | None,
                 first: int = FIRST_PROBES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(first routes, their candidates, further routes) of an exact search over ``queries`` (query, _emb, _k).

    Further routes are the lists, beyond the ``first`` nearest, whose nearest possible vector scores
    at least the query's k-th score found so far (or the floor).
    """
    radius = index.radius
    order = lambda angles: np.argsort(angles, axis=1, kind="stable")
    early = _routes(queries, index, lambda angles, _: list(order(angles)[:, :first]))
    found = materialize(_candidates(early, index, query_id, min_score, block_rows), "ivf_found")
    w = Window.partitionBy(query_id).orderBy(F.col("score").desc())
    kth = (found.join(queries.select(query_id, "_k"), query_id).withColumn("_rank", F.row_number().over(w))
           .where(F.col("_rank") == F.col("_k")).select(query_id, F.col("score").alias("_kth")))
    floors = queries.join(kth, query_id, "left").withColumn("_floor", F.greatest(F.coalesce("_kth", F.lit(-2.0)), F.lit(float(min_score)))).drop("_kth")

    def may_hold(angles: np.ndarray, floor: np.ndarray) -> list[np.ndarray]:
        nearest = np.cos(np.maximum(angles - radius[None, :], 0.0))
        open_lists = nearest >= floor[:, None] - SLACK
        np.put_along_axis(open_lists, order(angles)[:, :first], False, axis=1)
        return [np.nonzero(row)[0] for row in open_lists]

    return early, found, _routes(floors, index, may_hold)


def search_exact(queries: DataFrame, index: Index, query_id: str = "query_id", q_emb: str = "embedding", k: int | str | None = None,
                 min_score: float | None = None, block_rows: int | None = None, tie_cols: Sequence[str] = ()) -> DataFrame:
    """Exact top-k (query, chunk, rank, score) that reads only lists which can hold a result.

    Query ids are unique; vectors without a direction find nothing and are not found. Ties go by
    ``tie_cols`` (columns stored in the index), then by the chunk's id.
    """
    floor = DEFAULT_MIN_SCORE if min_score is None else min_score
    q = materialize(_prepared(queries, query_id, q_emb, k), "ivf_queries")
    _, found, further = exact_routes(q, index, query_id, floor, block_rows)
    both = found.unionByName(_candidates(further, index, query_id, floor, block_rows))
    ties = [c for c in tie_cols if c != index.chunk_id]
    if ties:
        both = both.join(index.rows(queries.sparkSession).select(index.chunk_id, *ties), index.chunk_id)
    return top_k(both, q.select(query_id, "_k"), query_id, index.chunk_id, ties)


def scored_share(queries: DataFrame, index: Index, query_id: str = "query_id", q_emb: str = "embedding", k: int | str | None = None,
                 min_score: float | None = None, block_rows: int | None = None) -> DataFrame:
    """One row: pairs that ``search_exact`` scores, all pairs of a query and a chunk in a list, and their share."""
    floor = DEFAULT_MIN_SCORE if min_score is None else min_score
    q = materialize(_prepared(queries, query_id, q_emb, k), "ivf_queries")
    early, _, further = exact_routes(q, index, query_id, floor, block_rows)
    size = F.get(F.array(*[F.lit(int(n)) for n in index.sizes] or [F.lit(0)]), F.col("list_id"))
    scored = early.select("list_id").unionByName(further.select("list_id")).agg(F.coalesce(F.sum(size), F.lit(0)).alias("scored_pairs"))
    every = q.agg((F.count(F.lit(1)) * int(index.sizes.sum())).alias("all_pairs"))
    return scored.withColumn("all_pairs", every.scalar()).withColumn("share", F.try_divide("scored_pairs", "all_pairs"))
