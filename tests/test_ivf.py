import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import ivf as IV
from tidewater.sources import published as P


def frame(spark, vectors, name="id", extra=False):
    rows = [(i, None if v is None else [float(x) for x in v]) + ((f"text {i}",) if extra else ()) for i, v in vectors.items()]
    return spark.createDataFrame(rows, f"{name} long, embedding array<float>" + (", content string" if extra else ""))


def brute(queries, chunks, k, floor):
    """By single precision vectors, as stored; ties to the smaller id."""
    unit = lambda v: (lambda x: x / np.linalg.norm(x))(np.asarray(v, np.float32).astype(np.float64))
    out = set()
    for q, v in queries.items():
        scores = sorted((-round(min(float(unit(v) @ unit(c)), 1.0), 12), i) for i, c in chunks.items() if c is not None and np.any(c) and np.isfinite(c).all())
        out |= {(q, i, r + 1, round(-s, 6)) for r, (s, i) in enumerate([x for x in scores if -x[0] >= floor][:k])}
    return out


def clustered(n, centers=12, width=16, spread=0.15, seed=3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centers, width))
    return {i: middle[i % centers] + spread * rng.normal(size=width) for i in range(n)}


def got(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("spread", [0.15, 5.0])
def test_exact_search_prunes_and_finds_all(spark, tmp_dir, spread):
    chunks = clustered(900, spread=spread)
    chunks |= {900: chunks[5].copy(), 901: np.zeros(16), 902: None, 903: np.full(16, np.nan), 904: np.full(16, np.inf)}
    queries = clustered(60, spread=spread, seed=3) | {60: chunks[5] * 3}
    index = IV.build_index(frame(spark, chunks, extra=True), tmp_dir + "/index", lists=12)
    assert index.rows(spark).count() == len(chunks) and sum(index.sizes) == 901
    q = frame(spark, queries, "query_id")
    usable = {i: c for i, c in chunks.items() if i <= 900}
    assert got(IV.search_exact(q, index, min_score=0.1, k=7, block_rows=50)) == brute(queries, usable, 7, 0.1)
    assert got(IV.search(q, index, min_score=0.1, k=7, probes=12)) == brute(queries, usable, 7, 0.1)
    share = IV.scored_share(q, index, min_score=0.1, k=7).first()
    assert share["all_pairs"] == 61 * 901 and (share["share"] < 0.35 if spread < 1 else share["share"] <= 1)


def test_appending_equals_a_rebuild_with_the_same_lists(spark, tmp_dir):
    chunks, queries = clustered(600), clustered(40, seed=8)
    first, second = ({i: c for i, c in chunks.items() if (i % 5 == 0) == late} for late in (False, True))
    index = IV.build_index(frame(spark, first), tmp_dir + "/a", lists=10)
    both = IV.append_to_index(frame(spark, second), index)
    whole = IV.with_lists(frame(spark, chunks), "embedding", index.centers)
    assert sorted(both.rows(spark).select("id", "list_id", "angle").collect()) == sorted(whole.select("id", "list_id", "angle").collect())
    assert both.sizes.sum() == 600 and (both.radius >= index.radius).all()
    q = frame(spark, queries, "query_id")
    assert got(IV.search_exact(q, both, min_score=-1.0)) == brute(queries, chunks, 5, -1.0)
    again = IV.open_index(spark, tmp_dir + "/a")
    assert got(IV.search(q, again, min_score=-1.0, probes=3)) == got(IV.search(q, both, min_score=-1.0, probes=3))


def test_recall_on_clustered_vectors(spark, tmp_dir):
    chunks, queries = clustered(1200, centers=30), clustered(60, centers=30)
    index = IV.build_index(frame(spark, chunks), tmp_dir + "/index", lists=30)
    q = frame(spark, queries, "query_id")
    exact = {r[:2] for r in got(IV.search_exact(q, index, min_score=0.2))}
    found = {r[:2] for r in got(IV.search(q, index, min_score=0.2, probes=3))}
    assert len(exact & found) >= 0.9 * len(exact) > 0


def test_unprobed_lists_are_pruned(spark, tmp_dir):
    chunks = clustered(600, centers=10)
    index = IV.build_index(frame(spark, chunks), tmp_dir + "/index", lists=10)
    one = IV._routes(IV._prepared(frame(spark, {0: chunks[0]}, "query_id"), "query_id", "embedding", 3), index,
                     lambda angles, _: list(np.argsort(angles, axis=1)[:, :1]))
    found = IV._candidates(one, index, "query_id", 0.0, 8192)
    plan = found._jdf.queryExecution().executedPlan().toString()
    probed = one.first()["list_id"]
    assert f" = {probed})" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert 0 < found.count() < 600 / 5


def test_an_interrupted_append_leaves_the_index(spark, tmp_dir, monkeypatch):
    chunks = clustered(300)
    index = IV.build_index(frame(spark, {i: chunks[i] for i in range(200)}), tmp_dir + "/index", lists=6)
    late = frame(spark, {i: chunks[i] for i in range(200, 300)})
    real = IV.publish

    def dies(df, path, *a):
        if path.endswith("/rows"):
            raise KeyboardInterrupt
        return real(df, path, *a)

    with monkeypatch.context() as m:
        m.setattr(IV, "publish", dies)
        with pytest.raises(KeyboardInterrupt):
            IV.append_to_index(late, index)
    queries = clustered(20, seed=4)
    q = frame(spark, queries, "query_id")
    half = IV.open_index(spark, tmp_dir + "/index")
    assert got(IV.search_exact(q, half, min_score=0.0)) == brute(queries, {i: chunks[i] for i in range(200)}, 5, 0.0)
    whole = IV.append_to_index(late, half)
    assert got(IV.search_exact(q, whole, min_score=0.0)) == brute(queries, chunks, 5, 0.0)
    assert P.read_published(spark, tmp_dir + "/index/rows").count() == 300


def test_empty_and_faults(spark, tmp_dir):
    q = frame(spark, {1: [1.0, 0.0]}, "query_id")
    empty = IV.build_index(frame(spark, {1: [0.0, 0.0], 2: None}), tmp_dir + "/none")
    assert IV.search(q, empty).count() == 0 and IV.search_exact(q, empty).count() == 0
    few = IV.build_index(frame(spark, {1: [1.0, 0.0], 2: [0.0, 1.0]}), tmp_dir + "/few")
    assert [r["id"] for r in IV.search_exact(q, few).collect()] == [1]
    assert IV.search_exact(q.limit(0), few).count() == 0
    with pytest.raises(ValueError, match="angle"):
        IV.build_index(frame(spark, {1: [1.0]}).withColumn("Angle", F.lit(1)), tmp_dir + "/clash")


def test_k_of_each_query_and_ties(spark, tmp_dir):
    chunks = {i: [1.0, 0.0] for i in range(6)} | {9: [0.6, 0.8]}
    index = IV.build_index(frame(spark, chunks).withColumn("age", -F.col("id")), tmp_dir + "/index", lists=2)
    q = frame(spark, {1: [2.0, 0.0], 2: [1.0, 0.0]}, "query_id").withColumn("k", F.when(F.col("query_id") == 1, 2).otherwise(0))
    rows = IV.search_exact(q, index, k="k", min_score=0.5, tie_cols=["age"]).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["id"]) for r in rows] == [(1, 5), (1, 4)] + [(2, i) for i in (5, 4, 3, 2, 1)]


def test_scores_are_held_a_slice_at_a_time(monkeypatch):
    """However many queries meet however many chunks, the scores in hand stay below the bound."""
    rng = np.random.default_rng(5)
    asked, units = (IV.unit_rows(rng.normal(size=(n, 8)))[1] for n in (300, 70))
    ks = [1 + i % 4 for i in range(300)]
    monkeypatch.setattr(IV, "SCORE_CELLS", 700)
    seen, held = {}, []
    plain = IV.best_of
    monkeypatch.setattr(IV, "best_of", lambda s, k, floor: held.append(s.base.size) or plain(s, k, floor))
    for again, hits, scores in IV.best_pairs(asked, ks, units, 0.2):
        assert len(set(again)) <= 10
        seen |= {(int(q), int(c)): x for q, c, x in zip(again, hits, scores, strict=True)}
    whole = np.minimum(asked @ units.T, 1.0)
    assert set(seen) == {(q, int(c)) for q in range(300) for c in plain(whole[q], ks[q], 0.2)}
    assert all(abs(whole[at] - x) < 1e-12 for at, x in seen.items()) and max(held) <= 700


def test_blocks_are_as_large_as_their_width_allows():
    """A query is sent to every block, so narrow vectors come in few blocks, and wide ones keep to the same memory."""
    index = lambda width: IV.Index("", "id", "embedding", np.ones((3, width)), np.zeros(3), np.array([0, 32_000, 100_000]))
    assert IV.list_blocks(index(64)) == [1, 1, 4] and IV.list_blocks(index(1024)) == [1, 16, 49]
    assert IV.list_blocks(index(64), 8192) == [1, 4, 13]
