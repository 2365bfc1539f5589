"""Vector retrieval: exact cosine top-k and document chunks.

Exact search never materialises query × chunk pairs as rows and never cross joins. A query set
below a byte bound is broadcast: the chunks are scanned where they lie, each task keeps every
query's local top-k, and nothing but those candidates moves. For a larger set the chunks are put
into lists (``operators.ivf``), and each query travels only to the lists that can hold one of its
best k. Either way blocks are scored by matrix products in an Arrow-batched function, and
``row_number() <= k`` merges the candidates. To search the same chunks again, keep the index.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.ivf import (DEFAULT_LISTS, DEFAULT_MIN_SCORE, DEFAULT_TOP_K, best_pairs, build_index,
                                     effective_k, search_exact, unit_rows)
from tidewater.operators.ivf import top_k as merge_top_k
from tidewater.session import shared_dir

__all__ = ["DEFAULT_TOP_K", "DEFAULT_MIN_SCORE", "DEFAULT_LISTS"]

# Fixed value: embedding width.
DEFAULT_DIM = 768

# Upper bound of the vectors (8 bytes a component) of a query set that is broadcast.
QUERY_BROADCAST_BYTES = 32 * 1024 * 1024


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two array columns in double precision; NULL for a zero vector."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                      lambda acc, v: acc + v)
    na = F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    nb = F.sqrt(F.aggregate(b, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return F.try_divide(dot, na * nb)


def vector_topk_batch(queries: DataFrame, chunks: DataFrame, query_id: str = "query_id",
                      chunk_id: str = "id", q_emb: str = "embedding", c_emb: str = "embedding",
                      top_k: int | str | None = None, min_score: float | None = None,
                      tie_cols: Sequence[str] | None = None, lists: int = DEFAULT_LISTS,
                      list_block_rows: int | None = None,
                      broadcast_bytes: int = QUERY_BROADCAST_BYTES) -> DataFrame:
    """Exact cosine top-k for many queries: (query_id, chunk_id, rank, score).

    ``top_k`` is an int or the name of a per-query column; 0/NULL means the default (5).
    The floor is inclusive (default 0.65). Ties on score go to the smaller chunk id
    (``tie_cols``, columns of the chunks, come first). Scores are clamped to 1 and rounded to 6 decimals.
    """
    floor = DEFAULT_MIN_SCORE if min_score is None else min_score
    q = queries.select(F.col(query_id), F.col(q_emb).alias("_emb"), effective_k(top_k).alias("_k"))
    size = q.agg(F.coalesce(F.sum(F.size("_emb")), F.lit(0)).alias("parts")).first()
    ties = [c for c in tie_cols or () if c != chunk_id]
    if 8 * size["parts"] <= broadcast_bytes:
        cand = _scan_chunks(q, chunks.select(F.col(chunk_id), F.col(c_emb).alias("_emb")), query_id, chunk_id, floor)
        # a constant k needs no per-query lookup (no extra join)
        ks = q.select(query_id, "_k") if isinstance(top_k, str) else effective_k(top_k)
        cand = cand.join(chunks.select(chunk_id, *ties), chunk_id) if ties else cand
        return merge_top_k(cand, ks, query_id, chunk_id, ties)
    index = build_index(chunks.select(chunk_id, c_emb, *ties), shared_dir(chunks.sparkSession, "topk_index"), chunk_id, c_emb, lists)
    return search_exact(queries, index, query_id, q_emb, top_k, floor, list_block_rows, ties)


def _scan_chunks(q: DataFrame, c: DataFrame, query_id: str, chunk_id: str, floor: float) -> DataFrame:
    """Candidates of a broadcast query set (checked size): one narrow pass over the chunks."""
    asked = q.toPandas()
    at, units = unit_rows(asked["_emb"])
    shared = q.sparkSession.sparkContext.broadcast((asked[query_id].to_numpy()[at], asked["_k"].to_numpy()[at].tolist(), units))
    schema = T.StructType([q.schema[query_id], c.schema[chunk_id], T.StructField("score", T.DoubleType())])

    def scan(batches):
        qids, ks, wanted = shared.value
        for batch in batches:
            at, vectors = unit_rows(batch["_emb"], wanted.shape[1] if len(wanted) else None)
            if not len(at) or not len(wanted):
                continue
            cids = batch[chunk_id].to_numpy()[at]
            for again, hits, scores in best_pairs(wanted, ks, vectors, floor):
                yield pd.DataFrame({query_id: qids[again], chunk_id: cids[hits], "score": scores})

    return c.mapInPandas(scan, schema)


def vector_topk(query: Sequence[float], chunks: DataFrame, chunk_id: str = "id",
                c_emb: str = "embedding", top_k: int | None = None,
                min_score: float | None = None) -> DataFrame:
    """One query vector: the search endpoint's ``ORDER BY score DESC LIMIT k``."""
    spark = chunks.sparkSession
    q = spark.createDataFrame([(0, [float(x) for x in query])], "query_id int, embedding array<double>")
    return vector_topk_batch(q, chunks, "query_id", chunk_id, "embedding", c_emb, top_k, min_score).drop("query_id")


def centroids(df: DataFrame, group_col: str, emb_col: str = "embedding") -> DataFrame:
    """Mean vector per group (element-wise): posexplode → average per position → ordered array.
    Each group ends as one row of ``dim`` values, so the final collect is bounded by dim."""
    ex = df.select(group_col, F.posexplode(emb_col).alias("pos", "v"))
    avg = ex.groupBy(group_col, "pos").agg(F.avg(F.col("v").cast("double")).alias("v"))
    return avg.groupBy(group_col).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]).alias(emb_col))


def chunk_documents(docs: DataFrame, text_col: str = "text", size: int = 1000, overlap: int = 100) -> DataFrame:
    """Fixed-size character windows with overlap: (…, chunk_index, content).

    ``n = max(1, ceil((len - overlap) / (size - overlap)))`` chunks; chunk i starts at
    ``i * (size - overlap)``. Whole texts are covered; empty texts give no chunk.
    """
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    step = size - overlap
    n = F.greatest(F.lit(1), F.ceil((F.length(text_col) - overlap) / F.lit(step))).cast("int")
    keep = [c for c in docs.columns if c != text_col]
    out = docs.filter(F.length(text_col) > 0).select(
        *keep, F.col(text_col), F.posexplode(F.sequence(F.lit(0), n - 1)).alias("chunk_index", "_i"))
    return out.select(*keep, F.col("chunk_index").cast("int").alias("chunk_index"),
                      F.substring(F.col(text_col), F.col("_i") * step + 1, F.lit(size)).alias("content"))


def chunk_id(document_id: Column, chunk_index: Column) -> Column:
    """Deterministic chunk id (SHA-256 of document id and index)."""
    return F.sha2(F.concat_ws(":", document_id.cast("string"), chunk_index.cast("string")), 256)


def check_dims(chunks: DataFrame, dim: int, emb_col: str = "embedding"):
    """Split rows into (valid, rejected) by embedding width (``vector(dim)`` rejects others).
    Rejected rows carry a ``reason``: no vector, or a wrong width."""
    ok = F.coalesce(F.size(emb_col) == dim, F.lit(False)) & F.col(emb_col).isNotNull()
    reason = F.when(F.col(emb_col).isNull(), "no vector").otherwise("wrong width")
    return chunks.filter(ok), chunks.filter(~ok).withColumn("reason", reason)
