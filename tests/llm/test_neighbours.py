import numpy as np
from pyspark.sql import functions as F

from tidewater.llm import neighbours as H

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, asks, k=5):
    ok = {}
    for i, v in rows:
        if i is None or v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        ok.setdefault(i, np.array(v, np.float32).astype(np.float64))
    out = {}
    for q in ok:
        if asks(q):
            scored = [(-(ok[i] @ ok[q]) / (np.linalg.norm(ok[i]) * np.linalg.norm(ok[q])), i) for i in ok if i != q and len(ok[i]) == len(ok[q])]
            out[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in scored)[:k]]
    return out


def collect(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(60)]
    rows += [(100, None), (101, [0.0] * 8), (102, [None] + [1.0] * 7), (103, [float("nan")] + [1.0] * 7), (104, [float("inf")] * 8),
             (None, [1.0] * 8), (105, []), (106, [1.0, 2.0]), (110, [2.0, 4.0]), (107, [1e30] * 8), (0, rows[0][1])]
    rows += [(200 + i, rows[3][1]) for i in range(40)]  # ties go to the smaller id
    got = collect(H.nearest(frame(spark, rows), F.col("vec_id") % 10 == 0))
    want = brute(rows, lambda q: q % 10 == 0)
    assert set(got) == set(want) - {q for q in want if not want[q]}
    for q in got:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-12)
    assert [i for i, _ in got[110]] == [106]


def test_recall_over_shards(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 32))
    rows = [(i, (centres[i % 30] + 0.4 * rng.normal(size=32)).tolist()) for i in range(3000)]
    got = collect(H.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0, shard_nodes=800))
    want = brute(rows, lambda q: q % 50 == 0)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_recall_of_the_registered_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    got = collect(H.op10_neighbours(spark, "/root/testdata/sf0.1"))
    want = brute(rows, lambda q: q % 50 == 0)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_stored_graph_searches_alike():
    rng = np.random.default_rng(2)
    v = H.unit(rng.normal(size=(700, 16)))
    graph = H.Hnsw.build(v)
    again = H.Hnsw.restored(v, graph.stored())
    for q in v[:40]:
        assert sorted(graph.search(q, 6)) == sorted(again.search(q, 6))
    assert H.Hnsw.build(np.empty((0, 4))).search(np.ones(4), 3) == []


def test_empty(spark):
    assert H.nearest(frame(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    assert H.nearest(frame(spark, [(0, [1.0, 0.0])]), F.col("vec_id") % 50 == 0).count() == 0
    assert H.nearest(frame(spark, [(1, [1.0, 0.0]), (2, [1.0, 0.0])]), F.col("vec_id") % 50 == 0).count() == 0
