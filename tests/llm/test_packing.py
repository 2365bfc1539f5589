

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.plain import check_packed
from tidewater.llm import packing as P
from tidewater.llm.scratch import Scratch


@pytest.fixture(scope="module")
def tokenizer():
    return P.WordTokenizer(P.vocabulary_path())


ODD = ["", " ", "a  b\n\nc\td\x0be\x0cf\r\ng", "Café café ́x   y z　w", "<|endoftext|>foo <|startoftext|> bar",
       "日本語 テスト中国\x1cabc\x85def", "a\x1cb a\x1fb \x7f x\x85y", "'s it's WE'RE 123 4567 !!! ??",
       "İstanbul ΣΑΣ ǅ ͅ ᄀ ᅡ", "a" * 50_000, "​ x​y ﻿ z", "\U0001f600 x\U0001f600",
       "̀ ̀a", "<|endof text|>", "ﬁ Å", "²³¼ ªº×÷ Ⱥ ß ẞ ŉ", "don't 'sS ''s 'll'd '''"]


def test_ids_equal_the_whole_text_encoding(tokenizer, documents):
    import random

    r = random.Random(1)
    alphabet = "ab'sS ’'\n\t éÉßİ1²_-.<|>end oftẋΣ"
    texts = ODD + ["".join(r.choices(alphabet, k=60)) for _ in range(1500)] + [t or "" for _, t, _, _ in documents[:60]]
    whole = Tokenizer.from_file(P.vocabulary_path())
    for t in texts:
        ids = whole.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(tokenizer.ids(t), "<u4").tolist() == ids, repr(t[:60])


def test_texts_of_a_batch_keep_apart(tokenizer, documents, monkeypatch):
    """Slices of a batch, offsets into a parent array, and texts longer than a slice."""
    import pyarrow as pa

    monkeypatch.setattr(P, "SLICE_CHARS", 500)
    whole = Tokenizer.from_file(P.vocabulary_path())
    texts = [None, "x" * 30, *ODD, *[t for _, t, _, _ in documents[:40]], "", None]
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    for part, expect in ((pa.array(texts), want), (pa.array(texts).slice(3, 30), want[3:33]), (pa.array([], pa.string()), [])):
        assert [np.frombuffer(b, "<u4").tolist() for b in tokenizer.encode(part)] == expect


def test_caches_start_anew(monkeypatch):
    monkeypatch.setattr(P, "CACHE_BYTES", 600)
    small, whole = P.WordTokenizer(P.vocabulary_path()), Tokenizer.from_file(P.vocabulary_path())
    for t in ["one two three four", "two five 日 本 six", "one one seven"]:
        assert np.frombuffer(small.ids(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def test_query_on_small_tables(spark, make_docs, as_documents, tokenizer):
    rows = [(1, "word " * 5000, "en", "s"), (2, None, "en", "s"), (3, "", "en", "s"), (3, "", "en", "s"), (None, "x y", "en", "s"),
            (4, "a" * 30_000, "en", "s")] + [(10 + i, "tok " * (i * 37 % 1500), "en", "s") for i in range(120)]
    got = P.op6_packing(spark, as_documents(make_docs(rows))).collect()
    n, bound = check_packed(got, [(i, t) for i, t, _, _ in rows], tokenizer, 2048)
    assert n <= bound + 1
    assert P.op6_packing(spark, as_documents(make_docs([]))).count() == 0


def test_full_corpus_is_near_the_bound(spark, documents, tokenizer):
    got = P.op6_packing(spark, "/root/testdata/sf0.001").collect()
    n, bound = check_packed(got, [(i, t) for i, t, _, _ in documents], tokenizer, 2048)
    assert n <= bound * 1.02 + 1


def test_many_shards_and_clashing_names(spark, make_docs, tokenizer):
    rows = [(i, "tok " * (1 + i * 37 % 50), "en", "s") for i in range(300)]
    docs = make_docs(rows).withColumn("row", F.lit(0)).withColumn("shard", F.lit("x")).withColumn("length", F.lit(-1))
    got = P.pack(docs, capacity=64, shard_pieces=40, with_ids=True).collect()
    check_packed(got, [(i, t) for i, t, _, _ in rows], tokenizer, 64)
    assert all(len(r["ids"]) == 4 * r["length"] for r in got)
    with pytest.raises(ValueError):
        P.token_pieces(docs, capacity=0)


def test_genetic_steps_keep_every_item_once():
    rng = np.random.default_rng(3)
    sizes = rng.integers(400, 1200, 500)
    one, two = (P.seed_individual(sizes, 2048, rng, n) for n in (0.0, 0.4))
    for child in (P.crossover(one, two, sizes, 2048, rng), P.mutate(one, sizes, 2048, rng)):
        assert len(child) == 500 and np.bincount(child, weights=sizes).max() <= 2048
        assert set(child.tolist()) == set(range(child.max() + 1))
    grown = P.evolve([], sizes, 2048, rng, generations=15)
    assert P.fitness(grown[0], sizes, 2048) <= P.fitness(one, sizes, 2048)


def test_evolution_beats_best_fit_where_there_is_room():
    # triples that fill a bin exactly, which best fit by falling size takes apart
    rng = np.random.default_rng(5)
    a = rng.integers(500, 850, 200)
    b = rng.integers(400, 650, 200)
    sizes = np.concatenate([a, b, 2048 - a - b])
    plain = P.fitness(P.seed_individual(sizes, 2048, rng, 0.0), sizes, 2048)[0]
    grown = P.fitness(P.evolve([], sizes, 2048, rng, generations=60, size=8)[0], sizes, 2048)[0]
    assert 200 <= grown < plain


def test_hot_size(spark):
    pieces = spark.range(5000).select(F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 700).otherwise(F.col("id") % 2047 + 1).cast("long").alias("length"))
    got = P.assign_sequences(pieces, Scratch(spark, "t"), shard_pieces=500)
    rows = got.join(pieces, "row")
    assert rows.count() == 5000
    worst = rows.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).agg(
        F.max("n").alias("n"), F.sum(F.abs(F.col("n") - F.col("end"))).alias("gaps")).first()
    assert worst["n"] <= 2048 and worst["gaps"] == 0
