import zlib
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from tidewater.llm.sharding import SHARDS, TOLERANCE, document_sizes, op11_sharding, shard_rows, splitters


def brute_splitters(pairs, parts):
    """Lowest key right of the boundary nearest to each target, by a full sort."""
    by = {}
    for k, w in pairs:
        by[k] = by.get(k, 0) + w
    keys = sorted(by)
    sums = [0, *accumulate(by[k] for k in keys)]
    out = []
    for j in range(1, parts):
        target = sums[-1] * j / parts
        out.append(min(range(len(sums)), key=lambda i: (abs(sums[i] - target), sums[i])))
    return [sums[i] for i in out], sums[-1]


def below(pairs, splitter):
    return sum(w for k, w in pairs if k < splitter)


@pytest.mark.parametrize("probes", [16, 100, 4096])
def test_splitters_against_a_full_sort(spark, probes):
    pairs = [((i * 2654435761) % 2**40, 1 + (i * 31) % 97) for i in range(3000)]
    pairs += [(2**61 + 5, 40)] * 1500 + [(2**61 + 6, 3)] * 10 + [(-7, 2), (0, 1), (2**62 - 1, 9)]
    rows = spark.createDataFrame(pairs, "key long, weight long")
    want, total = brute_splitters(pairs, 6)
    got = splitters(rows, 6, 0.0, probes)
    assert [below(pairs, s) for s in got] == want
    loose = splitters(rows, 6, 0.05, probes)
    for s, exact, j in zip(loose, want, range(1, 6), strict=True):
        target = total * j / 6
        assert abs(below(pairs, s) - target) <= max(0.05 * total / 6, abs(exact - target))


def test_splitters_of_few_rows(spark):
    rows = spark.createDataFrame([(5, 1), (9, 1)], "key long, weight long")
    assert [below([(5, 1), (9, 1)], s) for s in splitters(rows, 4, 0.0)] == [0, 1, 1]
    assert splitters(rows.limit(0), 4) == []
    one = spark.createDataFrame([(7, 10)], "key long, weight long")
    assert len(splitters(one, 3, 0.0)) == 2


def check(rows, sizes, tolerance=TOLERANCE):
    """Gapless slots, near-equal sums: each border within the tolerance or the largest size of its target."""
    total, shards = sum(sizes), {}
    for r in rows:
        shards.setdefault(r["shard"], []).append(r)
    assert set(shards) <= set(range(SHARDS))
    run = 0
    for s in range(SHARDS):
        members = shards.get(s, [])
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
        run += sum(r["size"] for r in members)
        assert abs(run - total * (s + 1) / SHARDS) <= tolerance * total / SHARDS + max(sizes)


def test_query(spark, make_docs, as_documents):
    rows = [(i, f"text {i} é " * (1 + i % 40), "en", "s") for i in range(700)]
    rows += [(1000 + i, "the same copy", "en", "s") for i in range(500)]
    rows += [(3, "again", "en", "s")] * 3 + [(None, None, None, None), (None, "x", None, None), (9000, "", "en", "s")]
    rows += [(9001, "long " * 2000, "en", "s")]
    got = op11_sharding(spark, as_documents(make_docs(rows).repartition(7))).collect()
    size = lambda t: len((t or "").encode()) + 1
    want = sorted(((i, size(t), zlib.crc32((t or "").encode())) for i, t, _, _ in rows), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=repr) == want
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)}
    check(got, [size(t) for _, t, _, _ in rows])


def test_equal_texts_are_neighbours(spark, make_docs):
    rows = [(i, f"text {i % 300}", "en", "s") for i in range(1200)]
    got = shard_rows(document_sizes(make_docs(rows)).withColumn("text", F.lit(1)), 4, "text_hash").collect()
    order = [r["text_hash"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert sum(a != b for a, b in zip(order, order[1:], strict=False)) == 299


def test_reruns_copies_and_extra_columns(spark, make_docs):
    docs = make_docs([(7, "same", "en", "s")] * 4000).withColumn("key", F.lit("mine")).withColumn("interval", F.lit("own")).withColumn("span", F.lit(1))
    rows = docs.withColumn("size", F.lit(5))
    got = shard_rows(rows, SHARDS, "text")
    assert [c for c in got.columns if c in rows.columns] == rows.columns
    out = got.collect()
    check(out, [5] * 4000)  # one text is cut into all shards
    assert {(r["key"], r["interval"]) for r in out} == {("mine", "own")}
    with pytest.raises(ValueError, match="slot"):
        shard_rows(rows.withColumn("Slot", F.lit(1)), SHARDS, "text")
    assert shard_rows(rows.limit(0), SHARDS, "text").count() == 0
