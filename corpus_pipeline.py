"""Corpus pipeline: the stages of ``STAGES`` applied in turn to ``documents``.

Language identification, near-duplicate removal, redaction of personal data, mixing of sources
and packing into sequences. A stage takes (spark, docs, sf_dir), where ``docs`` is what the stage
before it kept, and returns a DataFrame with the columns of ``documents``; the last returns the
packed pieces. ``run`` writes each stage's output to the shared checkpoint folder and reads it
again, so a lost executor never reaches back beyond a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.langid import keep_identified
from tidewater.llm.mixing import mix
from tidewater.llm.neardup import keep_one
from tidewater.llm.packing import pack
from tidewater.llm.pii import redact
from tidewater.llm.scratch import Scratch
from tidewater.tables import table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the rest (no letters, no text, doubtful) go."""
    return keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest id."""
    return keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found spans replaced by their kind; n_chars follows the new text."""
    return redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources."""
    return mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their sequence and offset."""
    return pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Stages score, hash and train; they are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` through every stage; each stage's output is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"{k}-{name}")
    return docs
