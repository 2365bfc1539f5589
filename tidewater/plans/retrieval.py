"""Vector search, chunk store and RAG assembly queries.

Chunk store: ``documents`` cut into 1000-character chunks (100 overlap), each with a vector of
its own from ``embeddings``: number (7 × doc_id + 13 × chunk) modulo 1.1 × the table's rows, so
about one chunk in eleven has none and is rejected. Questions: user turns of ``conversations``
with the vector ``vec_id = conv_id``. The store is written once per query and read from there.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import ivf as IV
from tidewater.operators import merge as M
from tidewater.operators import rag as R
from tidewater.operators import vectors as VE
from tidewater.plans.pages import sql_strip
from tidewater.plans.registry import query
from tidewater.session import materialize, shared_dir
from tidewater.tables import table

CHUNK_SIZE, CHUNK_OVERLAP = 1000, 100
CREATED_AT = "2024-02-01 00:00:00"
BATCH_MIN_SCORE = 0.2
DIM = 64

CHUNKS_SQL = f"""
all_chunks AS (
  SELECT sha256(CAST(d.doc_id AS VARCHAR) || ':' || CAST(d.i AS VARCHAR)) AS id,
         CAST(d.doc_id AS VARCHAR) AS document_id, CAST(d.i AS INTEGER) AS chunk_index,
         substr(d.text, CAST(d.i * {CHUNK_SIZE - CHUNK_OVERLAP} + 1 AS BIGINT), {CHUNK_SIZE}) AS content,
         e.embedding
  FROM (SELECT doc_id, text, unnest(range(CAST(greatest(1, ceil((length(text) - {CHUNK_OVERLAP})
               / {float(CHUNK_SIZE - CHUNK_OVERLAP)})) AS BIGINT))) AS i
        FROM documents WHERE length(text) > 0) d
  LEFT JOIN embeddings e ON e.vec_id = (7 * d.doc_id + 13 * d.i)
            % (SELECT CAST(floor(count(*) * 1.1) AS BIGINT) FROM embeddings)),
chunks AS (SELECT * FROM all_chunks WHERE len(embedding) = {DIM})"""

QUESTIONS_SQL = """
q AS (SELECT CAST(c.conv_id AS VARCHAR) || ':' || CAST(c.turn AS VARCHAR) AS query_id, c.text AS question,
             e.embedding
      FROM conversations c JOIN embeddings e ON e.vec_id = c.conv_id WHERE c.role = 'user')"""


def topk_sql(queries: str, chunks: str, qid: str, cid: str, k: int, floor: float) -> str:
    return f"""SELECT qid AS query_id, cid AS chunk_id, CAST(rank AS INTEGER) AS rank,
       round(least(score, 1.0), 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, cid) AS rank FROM (
    SELECT qq.{qid} AS qid, cc.{cid} AS cid,
           list_cosine_similarity(CAST(qq.embedding AS DOUBLE[]), CAST(cc.embedding AS DOUBLE[])) AS score
    FROM {queries} qq, {chunks} cc) WHERE score >= {floor}) WHERE rank <= {k}"""


RESULTS_SQL = f"""WITH {CHUNKS_SQL}, {QUESTIONS_SQL},
results AS ({topk_sql('q', 'chunks', 'query_id', 'id', VE.DEFAULT_TOP_K, VE.DEFAULT_MIN_SCORE)})"""


def all_chunks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    numbers = emb.select(F.floor(F.count(F.lit(1)) * 1.1).cast("bigint")).scalar()
    ch = VE.chunk_documents(docs, "text", CHUNK_SIZE, CHUNK_OVERLAP).withColumn(
        "vec_id", F.pmod(F.col("doc_id") * 7 + F.col("chunk_index") * 13, numbers))
    return ch.join(emb, "vec_id", "left").select(
        VE.chunk_id(F.col("doc_id"), F.col("chunk_index")).alias("id"),
        F.col("doc_id").cast("string").alias("document_id"), "chunk_index", "content",
        F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source")).alias("metadata"),
        "embedding", F.lit(CREATED_AT).cast("timestamp").alias("created_at"))


def chunk_store(spark, sf_dir):
    """The valid chunks, written once and read back."""
    return materialize(VE.check_dims(all_chunks(spark, sf_dir), DIM)[0], "chunk_store")


def questions(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    emb = table(spark, sf_dir, "embeddings")
    return conv.join(emb, conv.conv_id == emb.vec_id).select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("query_id"),
        F.col("text").alias("question"), "embedding")


def retrieve(spark, sf_dir):
    """((query_id, chunk_id, rank, score), chunks): default k and floor over the store."""
    chunks = chunk_store(spark, sf_dir).withColumnRenamed("id", "chunk_id")
    return VE.vector_topk_batch(questions(spark, sf_dir), chunks, "query_id", "chunk_id"), chunks


@query("chunk_documents", f"""
SELECT doc_id, CAST(i AS INTEGER) AS chunk_index,
       substr(text, CAST(i * {CHUNK_SIZE - CHUNK_OVERLAP} + 1 AS BIGINT), {CHUNK_SIZE}) AS content
FROM (SELECT doc_id, text, unnest(range(CAST(greatest(1, ceil((length(text) - {CHUNK_OVERLAP})
             / {float(CHUNK_SIZE - CHUNK_OVERLAP)})) AS BIGINT))) AS i FROM documents WHERE length(text) > 0)""")
def q_chunk_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return VE.chunk_documents(docs, "text", CHUNK_SIZE, CHUNK_OVERLAP)


def appended_store(spark, sf_dir):
    """The store kept as a vector index: even chunk numbers when it is built, odd ones appended."""
    valid = VE.check_dims(all_chunks(spark, sf_dir), DIM)[0]
    index = IV.build_index(valid.filter(F.col("chunk_index") % 2 == 0), shared_dir(spark, "chunk_store"), lists=IVF_LISTS)
    return IV.append_to_index(valid.filter(F.col("chunk_index") % 2 == 1), index).rows(spark)


@query("append_chunks", f"""WITH {CHUNKS_SQL}
SELECT id, document_id, chunk_index, content, CAST(len(embedding) AS INTEGER) AS dims FROM chunks""")
def q_append_chunks(spark, sf_dir):
    return appended_store(spark, sf_dir).select("id", "document_id", "chunk_index", "content",
                                                F.size("embedding").alias("dims"))


@query("rejected_chunks", f"""WITH {CHUNKS_SQL}
SELECT document_id, chunk_index, CASE WHEN embedding IS NULL THEN 'no vector' ELSE 'wrong width' END AS reason
FROM all_chunks WHERE embedding IS NULL OR len(embedding) <> {DIM}""")
def q_rejected_chunks(spark, sf_dir):
    """Chunks that the store does not take, with the reason."""
    return VE.check_dims(all_chunks(spark, sf_dir), DIM)[1].select("document_id", "chunk_index", "reason")


@query("count_chunks", f"WITH {CHUNKS_SQL} SELECT count(*) AS chunks FROM chunks")
def q_count_chunks(spark, sf_dir):
    return chunk_store(spark, sf_dir).agg(F.count(F.lit(1)).alias("chunks"))


@query("delete_documents", f"""WITH {CHUNKS_SQL}
SELECT id, document_id, chunk_index FROM chunks
WHERE document_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE toxic = 1)""")
def q_delete_documents(spark, sf_dir):
    """Delete every chunk of a document labelled toxic (DELETE … WHERE document_id = …)."""
    store = chunk_store(spark, sf_dir)
    toxic = table(spark, sf_dir, "labels").filter(F.col("toxic") == 1).select(
        F.col("doc_id").cast("string").alias("document_id"))
    return M.delete_keys(store, toxic, "document_id").select("id", "document_id", "chunk_index")


@query("deleted_chunks", f"""WITH {CHUNKS_SQL}
SELECT count(*) AS deleted_rows FROM chunks
WHERE document_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE toxic = 1)""")
def q_deleted_chunks(spark, sf_dir):
    store = chunk_store(spark, sf_dir)
    toxic = table(spark, sf_dir, "labels").filter(F.col("toxic") == 1).select(
        F.col("doc_id").cast("string").alias("document_id"))
    return M.deleted_count(store, toxic, "document_id")


@query("vector_topk_batch", topk_sql("embeddings", "embeddings", "vec_id", "vec_id", VE.DEFAULT_TOP_K,
                                     BATCH_MIN_SCORE))
def q_vector_topk_batch(spark, sf_dir):
    """Every embedding as a query against all embeddings (k = 5, floor 0.2)."""
    emb = table(spark, sf_dir, "embeddings")
    qs = emb.select(F.col("vec_id").alias("query_id"), "embedding")
    cs = emb.select(F.col("vec_id").alias("chunk_id"), "embedding")
    return VE.vector_topk_batch(qs, cs, "query_id", "chunk_id", min_score=BATCH_MIN_SCORE)


_CENTROID_SQL = """
cent AS (SELECT label, list(v ORDER BY pos) AS embedding FROM (
  SELECT label, pos, avg(CAST(x AS DOUBLE)) AS v FROM (
    SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
  GROUP BY label, pos) GROUP BY label)"""


@query("vector_topk", f"""WITH {_CENTROID_SQL}
{topk_sql('cent', 'embeddings', 'label', 'vec_id', VE.DEFAULT_TOP_K, BATCH_MIN_SCORE)}""")
def q_vector_topk(spark, sf_dir):
    """Search with default k, floor 0.2 (no centroid reaches 0.65); one query per label centroid."""
    emb = table(spark, sf_dir, "embeddings")
    qs = VE.centroids(emb, "label").withColumnRenamed("label", "query_id")
    cs = emb.select(F.col("vec_id").alias("chunk_id"), "embedding")
    return VE.vector_topk_batch(qs, cs, "query_id", "chunk_id", min_score=BATCH_MIN_SCORE)


IVF_LISTS = 16


def embedding_index(spark, sf_dir, lists=IVF_LISTS):
    """(queries, index): every embedding as a query; the index is built on three quarters of them and
    the rest appended to it."""
    emb = table(spark, sf_dir, "embeddings")
    chunks = emb.select(F.col("vec_id").alias("chunk_id"), "label", "embedding")
    late = F.col("chunk_id") % 4 == 3
    index = IV.build_index(chunks.filter(~late), shared_dir(spark, "vector_index"), "chunk_id", lists=lists)
    return emb.select(F.col("vec_id").alias("query_id"), "embedding"), IV.append_to_index(chunks.filter(late), index)


_ALL_PAIRS_SQL = topk_sql("embeddings", "embeddings", "vec_id", "vec_id", VE.DEFAULT_TOP_K, BATCH_MIN_SCORE)


@query("vector_topk_ivf", _ALL_PAIRS_SQL)
def q_vector_topk_ivf(spark, sf_dir):
    """The stored index with every list probed, which is exact search by another road."""
    queries, index = embedding_index(spark, sf_dir)
    return IV.search(queries, index, min_score=BATCH_MIN_SCORE, probes=IVF_LISTS)


@query("vector_topk_pruned", _ALL_PAIRS_SQL)
def q_vector_topk_pruned(spark, sf_dir):
    """Exact search over the stored index: a list is read only for queries that it can hold a result of."""
    queries, index = embedding_index(spark, sf_dir)
    return IV.search_exact(queries, index, min_score=BATCH_MIN_SCORE)


@query("vector_index_rows", """
SELECT vec_id AS chunk_id, label, CAST(len(embedding) AS INTEGER) AS dims, TRUE AS listed FROM embeddings""")
def q_vector_index_rows(spark, sf_dir):
    """What the stored index holds: every chunk once, with its columns, in a list."""
    rows = embedding_index(spark, sf_dir)[1].rows(spark)
    return rows.select("chunk_id", "label", F.size("embedding").alias("dims"), (F.col("list_id") >= 0).alias("listed"))


@query("ivf_recall", f"""
SELECT (SELECT count(*) FROM embeddings) AS queries, count(*) AS exact_pairs, TRUE AS recall_at_least_090
FROM ({_ALL_PAIRS_SQL})""")
def q_ivf_recall(spark, sf_dir):
    """Share of the exact results that a search of 10 of 16 lists finds, for all embeddings."""
    queries, index = embedding_index(spark, sf_dir)
    exact = IV.search_exact(queries, index, min_score=BATCH_MIN_SCORE).select("query_id", "chunk_id")
    found = IV.search(queries, index, min_score=BATCH_MIN_SCORE, probes=10).select("query_id", "chunk_id", F.lit(1).alias("hit"))
    share = exact.join(found, ["query_id", "chunk_id"], "left").agg(F.count(F.lit(1)).alias("exact_pairs"), F.count("hit").alias("hits"))
    return share.select(queries.agg(F.count(F.lit(1))).scalar().alias("queries"), "exact_pairs",
                        (F.col("hits") >= 0.9 * F.col("exact_pairs")).alias("recall_at_least_090"))


@query("ivf_scored_share", "SELECT count(*) * count(*) AS all_pairs, TRUE AS within FROM embeddings")
def q_ivf_scored_share(spark, sf_dir):
    """Pairs of an exact search by the floor 0.2, of all pairs; the share depends on the lists."""
    queries, index = embedding_index(spark, sf_dir)
    share = IV.scored_share(queries, index, min_score=BATCH_MIN_SCORE)
    return share.select("all_pairs", F.col("scored_pairs").between(0, F.col("all_pairs")).alias("within"))


@query("rag_context", f"""{RESULTS_SQL}
SELECT r.query_id, string_agg('[' || CAST(r.rank AS VARCHAR) || '] (source: ' || c.document_id || ')' || chr(10)
                              || c.content || chr(10), chr(10) ORDER BY r.rank) AS context
FROM results r JOIN chunks c ON c.id = r.chunk_id GROUP BY r.query_id""")
def q_rag_context(spark, sf_dir):
    return R.rag_context(*retrieve(spark, sf_dir), "query_id", "chunk_id")


def _prompt_sql() -> str:
    sys_t = R.SYSTEM_TEMPLATE.replace("'", "''")
    q_t = R.QUESTION_TEMPLATE.replace("'", "''")
    return f"""{RESULTS_SQL},
ctx AS (SELECT r.query_id, string_agg('[' || CAST(r.rank AS VARCHAR) || '] (source: ' || c.document_id || ')'
                                      || chr(10) || c.content || chr(10), chr(10) ORDER BY r.rank) AS context
        FROM results r JOIN chunks c ON c.id = r.chunk_id GROUP BY r.query_id)
SELECT q.query_id, q.question,
       'SYSTEM:' || chr(10) || replace('{sys_t}', '{{context}}', coalesce(ctx.context, ''))
       || chr(10) || chr(10) || 'HUMAN:' || chr(10) || replace('{q_t}', '{{question}}', q.question) AS prompt
FROM q LEFT JOIN ctx ON ctx.query_id = q.query_id"""


@query("rag_prompts", _prompt_sql())
def q_rag_prompts(spark, sf_dir):
    qs = questions(spark, sf_dir)
    ctx = R.rag_context(*retrieve(spark, sf_dir), "query_id", "chunk_id")
    return R.rag_prompts(qs.select("query_id", "question"), ctx)


@query("rag_confidence", f"""{RESULTS_SQL}
SELECT q.query_id, round(coalesce(avg(r.score) FILTER (WHERE r.rank <= 3), 0.0), 6) AS confidence
FROM q LEFT JOIN results r ON r.query_id = q.query_id GROUP BY q.query_id""")
def q_rag_confidence(spark, sf_dir):
    return R.rag_confidence(questions(spark, sf_dir), retrieve(spark, sf_dir)[0])


@query("token_estimate", """
SELECT u.conv_id, u.turn, CAST(floor(length(u.text || a.text) / 4) AS BIGINT) AS total_tokens
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'""")
def q_token_estimate(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    u, a = conv.alias("u"), conv.alias("a")
    pairs = u.join(a, (F.col("a.conv_id") == F.col("u.conv_id")) & (F.col("a.turn") == F.col("u.turn") + 1)) \
        .filter((F.col("u.role") == "user") & (F.col("a.role") == "assistant"))
    return pairs.select(F.col("u.conv_id").alias("conv_id"), F.col("u.turn").alias("turn"),
                        R.token_estimate(F.col("u.text"), F.col("a.text")).alias("total_tokens"))


@query("validate_queries", f"""
SELECT conv_id, turn, top_k,
       CASE WHEN text IS NULL OR length(text) < 1 THEN 'empty query'
            WHEN length(text) > {R.MAX_QUERY_CHARS} THEN 'query too long'
            WHEN top_k IS NOT NULL AND (top_k < 1 OR top_k > 50) THEN 'top_k out of range' END AS reason,
       CASE WHEN text IS NULL OR length(text) < 1 OR length(text) > {R.MAX_QUERY_CHARS}
              OR (top_k IS NOT NULL AND (top_k < 1 OR top_k > 50)) THEN FALSE ELSE TRUE END AS is_valid,
       CAST(coalesce(top_k, 5) AS INTEGER) AS k
FROM (SELECT conv_id, turn, text, CAST(floor(length(text) / 6) AS INTEGER) AS top_k
      FROM conversations WHERE role = 'user')""")
def q_validate_queries(spark, sf_dir):
    req = table(spark, sf_dir, "conversations").filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("query"),
        F.floor(F.length("text") / 6).cast("int").alias("top_k"))
    return R.validate_queries(req, "query", "top_k").drop("query")


@query("parse_embeddings", """
SELECT vec_id,
       CASE WHEN label = 9 THEN NULL ELSE list_transform(embedding, lambda x: round(CAST(x AS DOUBLE), 6)) END
         AS vector,
       CASE WHEN label = 9 THEN 'unexpected embedding response format' END AS parse_error
FROM embeddings""")
def q_parse_embeddings(spark, sf_dir):
    """Landed responses in two valid shapes (by label) and one unexpected shape (label 9)."""
    emb = table(spark, sf_dir, "embeddings")
    v = F.transform("embedding", lambda x: F.round(x.cast("double"), 6))
    body = (F.when(F.col("label") == 9, F.to_json(F.struct(v.alias("vector"))))
            .when(F.col("label") < 5, F.to_json(F.struct(F.array(F.struct(v.alias("embedding"))).alias("data"))))
            .otherwise(F.to_json(F.struct(v.alias("embedding")))))
    return R.parse_embeddings(emb.select("vec_id", body.alias("body"))).select("vec_id", "vector", "parse_error")


@query("parse_completions", f"""
SELECT conv_id, turn, {sql_strip('text')} AS answer FROM conversations WHERE role = 'assistant'""")
def q_parse_completions(spark, sf_dir):
    """Landed completion bodies in four shapes: choices[0].text, choices[0].message.content,
    response, and raw text."""
    conv = table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
    t = F.col("text")
    shape = F.col("turn") % 4
    body = (F.when(shape == 0, F.to_json(F.struct(F.array(F.struct(t.alias("text"))).alias("choices"))))
            .when(shape == 1, F.to_json(F.struct(F.array(F.struct(F.struct(t.alias("content")).alias("message")))
                                                 .alias("choices"))))
            .when(shape == 2, F.to_json(F.struct(t.alias("response"))))
            .otherwise(t))
    return R.parse_completions(conv.select("conv_id", "turn", body.alias("body"))).select("conv_id", "turn", "answer")
