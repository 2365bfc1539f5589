"""The pipeline's stages on the smallest documents table, each held against a plain version."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as CP
from tests.llm.plain import brute_classes, check_packed, water
from tidewater.llm import packing, pii
from tidewater.llm.mixing import unit_draw

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """(name, input rows, output rows) of every stage, written and read between stages."""
    base = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    # junk that the first stage has to reject
    junk = spark.createDataFrame([(10**6, "12 34 !!", None, "src0", 8), (10**6 + 1, None, "en", None, None), (10**6 + 2, "", "en", "src1", 0)], docs.schema)
    docs = docs.unionByName(junk)
    for k, (name, stage) in enumerate(CP.STAGES):
        before = docs.collect()
        stage(spark, docs, SF).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
        out.append((name, before, docs.collect(), docs.columns))
    return out


def test_order_and_columns(staged):
    assert [s[0] for s in staged] == ["language_id", "near_dedup", "pii", "mixing", "packing"]
    assert all(sorted(s[3]) == ["doc_id", "lang", "n_chars", "source", "text"] for s in staged[:-1])


def test_language(staged):
    _, before, after, _ = staged[0]
    kept = {r["doc_id"] for r in after}
    assert all((r["doc_id"] in kept) == bool(r["text"] and re.search(r"[^\W\d_]", r["text"])) for r in before)
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_near_duplicates(staged):
    _, before, after, _ = staged[1]
    rows = sorted(before, key=lambda r: r["doc_id"])
    first = {}
    for r, c in zip(rows, brute_classes([r["text"] for r in rows]), strict=True):
        first.setdefault(c, r)
    assert sorted(map(tuple, after)) == sorted(map(tuple, first.values())) and len(after) < len(before)


def test_personal_data(staged):
    _, before, after, _ = staged[2]
    old = {r["doc_id"]: r for r in before}
    assert len(after) == len(before) and any("[EMAIL]" in r["text"] for r in after)
    for r in after:
        assert not pii.base_spans(r["text"]) and r["n_chars"] == len(r["text"])
        if not pii.base_spans(old[r["doc_id"]]["text"]):
            assert r["text"] == old[r["doc_id"]]["text"]


def test_mixing(spark, staged):
    _, before, after, _ = staged[3]
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0d]+", t))
    sizes = Counter()
    for r in before:
        sizes[r["source"]] += words(r["text"])
    target = water(dict(sizes))
    draws = {r["id"]: r["u"] for r in spark.createDataFrame([(r["doc_id"],) for r in before], "id bigint").select(
        "id", unit_draw(__import__("pyspark.sql.functions", fromlist=["col"]).col("id")).alias("u")).collect()}
    expect = Counter()
    for r in before:
        rate = target[r["source"]] / sizes[r["source"]]
        n = int(rate) + (draws[r["doc_id"]] < rate - int(rate))
        if n:
            expect[tuple(r)] = n
    assert Counter(map(tuple, after)) == expect


def test_packing(staged):
    _, before, after, _ = staged[4]
    tokenizer = packing.WordTokenizer(packing.vocabulary_path())
    n, bound = check_packed(after, [(r["doc_id"], r["text"]) for r in before], tokenizer, packing.CAPACITY)
    assert n <= 1.02 * bound + 1


def test_run_gives_the_last_stage(spark, staged):
    got = CP.run(spark, SF)
    assert got.columns == staged[-1][3] and got.count() > 0
    assert got.agg({"length": "max"}).first()[0] <= packing.CAPACITY


def test_every_stage_takes_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in CP.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
    assert np.uint32(zlib.crc32(b"")) == 0
