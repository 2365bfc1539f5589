"""Retrieval-augmented generation data assembly: context, prompts, confidence, tokens,
request validation and parsing of landed model responses.

Model calls stay outside Spark; these jobs prepare their inputs and read their outputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.text import estimate_tokens, strip_ws
from tidewater.operators.vectors import DEFAULT_TOP_K

# Our prompt template: system text with the retrieved context, then the question.
SYSTEM_TEMPLATE = (
    "Answer the user's question using only the context documents below. "
    "If they do not contain the answer, say that you do not know.\n\n"
    "Context documents:\n{context}\n\n"
    "Cite the source id of every fact you use and reply in the language of the question."
)
QUESTION_TEMPLATE = "Question: {question}"

# Request limits of the chat/search API.
MAX_QUERY_CHARS = 4096
TOP_K_RANGE = (1, 50)

# Context entry format (joined by a newline) and the role prefixes of the
# flattened prompt (messages joined by a blank line).
CONTEXT_ENTRY = "[%d] (source: %s)\n%s\n"
SYSTEM_PREFIX, HUMAN_PREFIX = "SYSTEM:\n", "HUMAN:\n"


def context_entry(rank: Column, source: Column, content: Column) -> Column:
    return F.format_string(CONTEXT_ENTRY, rank, source, content)


def rag_context(results: DataFrame, chunks: DataFrame, query_id: str = "query_id",
                chunk_id: str = "id", source_col: str = "document_id",
                content_col: str = "content") -> DataFrame:
    """Per query: numbered context entries in score order, joined by a newline.
    Each group holds at most k rows (the retrieval limit)."""
    j = results.join(chunks.select(F.col(chunk_id).alias("_cid"), source_col, content_col),
                     results[chunk_id] == F.col("_cid"))
    entries = j.groupBy(query_id).agg(F.array_sort(F.collect_list(F.struct(
        F.col("rank"), context_entry(F.col("rank"), F.col(source_col), F.col(content_col)).alias("e")))).alias("_l"))
    return entries.select(query_id, F.array_join(F.transform("_l", lambda s: s["e"]), "\n").alias("context"))


def rag_prompts(questions: DataFrame, contexts: DataFrame, query_id: str = "query_id",
                question_col: str = "question") -> DataFrame:
    """Role-prefixed prompt text per question; no retrieved context gives an empty context."""
    j = questions.join(contexts, query_id, "left")
    system = F.replace(F.lit(SYSTEM_TEMPLATE), F.lit("{context}"), F.coalesce(F.col("context"), F.lit("")))
    human = F.replace(F.lit(QUESTION_TEMPLATE), F.lit("{question}"), F.col(question_col))
    prompt = F.concat(F.lit(SYSTEM_PREFIX), system, F.lit("\n\n" + HUMAN_PREFIX), human)
    return j.select(query_id, question_col, prompt.alias("prompt"))


def rag_confidence(questions: DataFrame, results: DataFrame, query_id: str = "query_id") -> DataFrame:
    """Mean of the first three scores per query; 0.0 when nothing was retrieved."""
    top3 = results.filter(F.col("rank") <= 3).groupBy(query_id).agg(F.avg("score").alias("c"))
    return questions.select(query_id).join(top3, query_id, "left").select(
        query_id, F.round(F.coalesce(F.col("c"), F.lit(0.0)), 6).alias("confidence"))


def token_estimate(prompt: Column, answer: Column, usage_total: Column | None = None) -> Column:
    """Reported total tokens, else (prompt + answer characters) // 4."""
    est = estimate_tokens(F.concat(F.coalesce(prompt, F.lit("")), F.coalesce(answer, F.lit(""))))
    return est if usage_total is None else F.coalesce(usage_total.cast("bigint"), est)


def validate_queries(requests: DataFrame, query_col: str = "query", top_k_col: str | None = "top_k") -> DataFrame:
    """Request checks: 1..4096 characters; top_k NULL (default) or within 1..50.
    Adds ``is_valid``, ``reason`` and the effective ``k``."""
    n = F.length(F.col(query_col))
    reason = F.when(F.col(query_col).isNull() | (n < 1), "empty query").when(
        n > MAX_QUERY_CHARS, "query too long")
    k = F.lit(None).cast("int")
    if top_k_col:
        k = F.col(top_k_col)
        reason = reason.when(k.isNotNull() & ((k < TOP_K_RANGE[0]) | (k > TOP_K_RANGE[1])), "top_k out of range")
    return requests.withColumns({
        "reason": reason,
        "is_valid": reason.isNull(),
        "k": F.coalesce(k, F.lit(DEFAULT_TOP_K)).cast("int"),
    })


EMBEDDING_RESPONSE = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([T.StructField("embedding", T.ArrayType(T.DoubleType()))]))),
    T.StructField("embedding", T.ArrayType(T.DoubleType())),
])


def parse_embeddings(responses: DataFrame, body_col: str = "body") -> DataFrame:
    """OpenAI-style ``data[0].embedding`` or plain ``embedding``; neither → NULL + reason."""
    r = F.from_json(F.col(body_col), EMBEDDING_RESPONSE)
    vec = F.coalesce(F.element_at(r["data"], 1)["embedding"], r["embedding"])
    return responses.withColumns({"vector": vec, "parse_error": F.when(
        vec.isNull(), F.lit("unexpected embedding response format"))})


def parse_completions(responses: DataFrame, body_col: str = "body") -> DataFrame:
    """``choices[0].text``, else ``choices[0].message.content`` (else ''), when ``choices``
    exists; else ``response``; else the raw body. Trimmed."""
    b = F.col(body_col)
    has_choices = F.get_json_object(b, "$.choices").isNotNull()
    text = F.when(has_choices, F.coalesce(F.get_json_object(b, "$.choices[0].text"),
                                          F.get_json_object(b, "$.choices[0].message.content"), F.lit(""))) \
        .when(F.get_json_object(b, "$.response").isNotNull(), F.get_json_object(b, "$.response")) \
        .otherwise(b)
    return responses.withColumn("answer", strip_ws(text))
