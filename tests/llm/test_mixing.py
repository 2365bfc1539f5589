import pytest
from pyspark.sql import functions as F

from tests.llm.plain import water
from tidewater.llm.mixing import mix, mix_plan, op1_mix
from tidewater.llm.scratch import Scratch


def words(t):
    import re
    return len(re.findall(r"[^\x20\x09-\x0d]+", t or ""))


def test_targets_and_copies(make_docs):
    rows = [(i, "w " * (1 + i % 7), "en", s) for i, s in enumerate(["a"] * 60 + ["b"] * 3 + ["é"] * 20 + [None] * 9 + ["z"])]
    rows += [(900, None, "en", "a"), (901, "", "en", "empty"), (902, " \t\n\x0b\x0c\r", None, "empty"), (903, "x y", "en", "z")]
    got = mix_plan(make_docs(rows)).collect()
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    expect = water(sizes)
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expect[r["source"]], rel=1e-12)
        rate = expect[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        assert r["copies"] in (int(rate), int(rate) + 1) and r["copies"] <= 3
    assert sum(expect.values()) == pytest.approx(sum(sizes.values()))


def test_mix_emits_whole_rows(make_docs):
    rows = [(i, f"one two {i}", "en", "big") for i in range(40)] + [(100 + i, "few", "en", "small") for i in range(3)]
    docs = make_docs(rows).withColumn("size", F.lit("mine")).withColumn("copy", F.lit(1)).withColumn("rate", F.lit(None).cast("int"))
    out = mix(docs)
    assert out.schema == docs.schema
    plan = {r["doc_id"]: r["copies"] for r in mix_plan(docs).collect()}
    times = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert times == {k: v for k, v in plan.items() if v}
    assert {r["size"] for r in out.collect()} == {"mine"}


def test_near_target_on_many_documents(make_docs):
    rows = [(i, "w " * (1 + (i * 7919) % 50), "en", "s%d" % (i % 5 if i % 3 else 0)) for i in range(6000)]
    got = mix_plan(make_docs(rows)).groupBy("source").agg(
        F.first("target").alias("target"), F.sum(F.col("size") * F.col("copies")).alias("taken")).collect()
    for r in got:
        assert r["taken"] == pytest.approx(r["target"], rel=0.1)


def test_empty_and_repeated(spark, make_docs, as_documents):
    assert mix_plan(make_docs([])).count() == 0 and mix(make_docs([])).count() == 0
    assert mix(make_docs([(1, None, None, None), (None, "", None, None)])).count() == 0
    twice = [(7, "same words here", "en", "s")] * 2 + [(None, "a b", "en", "s")] * 2
    first, second = op1_mix(spark, as_documents(make_docs(twice))).collect(), None
    second = op1_mix(spark, as_documents(make_docs(twice))).collect()
    assert sorted(map(tuple, first), key=repr) == sorted(map(tuple, second), key=repr)
    by = {}
    for r in first:
        by.setdefault(r["doc_id"], set()).add(r["taken"])
    assert all(len(v) == 1 for v in by.values())


def test_sources_are_numbered_across_partitions(spark):
    from tidewater.llm.mixing import source_targets

    sizes = spark.range(500).select(F.format_string("s%04d", "id").alias("source"), F.lit(1).alias("size"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["source"]: r["target"] for r in source_targets(sizes, Scratch(spark, "t")).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == pytest.approx(water({f"s{i:04d}": 1 for i in range(500)}))
