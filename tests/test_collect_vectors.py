import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from tidewater.operators import rag as R
from tidewater.operators import vectors as VE
from tidewater.plans.collect import build_envelopes
from tidewater.sources import collector as CO
from tidewater.sources import incremental as I

T = dt.datetime
ITEM = "struct<id:string,user_id:bigint,event_type:string,value:double,ts:timestamp_ntz>"


def envelopes(spark):
    def it(i, uid=1):
        return (i, uid, "click", 1.0, T(2024, 1, 1))

    rows = [
        (1, "ok", [it("a"), it("b"), it(None)], "2", None, None),
        (2, "ok", [], "3", None, None),                          # empty page with a token
        (3, "ok", [it("b"), it("c"), it("")], "4", None, None),  # b repeats
        (4, "failed", None, None, None, None),
        (5, "ok", [it("z")], None, None, None),                  # landed, so it counts
    ]
    return spark.createDataFrame(rows, f"page int, status string, data array<{ITEM}>, next_page string, "
                                       "next_cursor string, request_cursor string")


def test_collect_takes_every_landed_page(spark):
    out = CO.collect_pages(envelopes(spark)).orderBy("page", "pos").collect()
    assert [(r.id, r.page) for r in out] == [("a", 1), ("b", 1), ("c", 3), ("z", 5)]
    assert CO.dropped_items(envelopes(spark)).first().dropped_no_id == 2


def test_order_and_repetition_of_landings_do_not_matter(spark):
    env = envelopes(spark)
    again = env.filter("page IN (5, 3)").unionByName(env.filter("page = 1")).unionByName(env).unionByName(env.filter("page = 3"))
    assert sorted(CO.collect_pages(again).collect()) == sorted(CO.collect_pages(env).collect())
    assert CO.dropped_items(again).first().dropped_no_id == 2
    assert sorted(CO.landing_stats(again).collect()) == sorted(CO.landing_stats(env).collect())


def test_landing_stats(spark):
    got = {r.status: (r.pages, r.empty_pages, r["items"]) for r in CO.landing_stats(envelopes(spark)).collect()}
    assert got == {"ok": (4, 1, 7), "failed": (1, 1, 0)}


def test_rows_grow_with_the_events(spark):
    small, large = (CO.collect_pages(build_envelopes(spark.read.parquet(f"/root/testdata/{sf}/events.parquet"))).count()
                    for sf in ("sf0.001", "sf0.01"))
    assert large > 5 * small


def test_incremental_ties_and_exact(spark):
    df = spark.createDataFrame([(1, T(2024, 1, 1)), (2, T(2024, 1, 2)), (3, T(2024, 1, 2)), (4, T(2024, 1, 3)),
                                (5, None)], "id int, ts timestamp")
    ties = sorted(r.id for r in I.incremental_extract(df, "ts", T(2024, 1, 1), limit=2).collect())
    exact = [r.id for r in I.incremental_extract(df, "ts", T(2024, 1, 1), limit=2, exact=True, tie_cols=["id"]).collect()]
    assert ties == [2, 3]
    assert exact == [2, 3]
    three = sorted(r.id for r in I.incremental_extract(df, "ts", T(2024, 1, 1), limit=1).collect())
    assert three == [2, 3]  # both rows at the boundary timestamp
    none = sorted(r.id for r in I.incremental_extract(df, "ts", T(2024, 1, 1)).collect())
    assert none == [2, 3, 4]  # no cap unless one is given
    one = [r.id for r in I.incremental_extract(df, "ts", T(2024, 1, 1), limit=1, exact=True, tie_cols=["id"]).collect()]
    assert one == [2]
    m = I.advance_mark(df.limit(0), "ts", T(2024, 1, 1)).first()
    assert m.rows_extracted == 0 and m.new_mark == T(2024, 1, 1)


def test_boundary_across_ranges(spark):
    """The cap is found whichever range of times it falls into."""
    df = spark.range(3000).select(F.col("id"), (F.lit(T(2024, 1, 1)) + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") / 3).cast("int"))).alias("ts"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for cap in (1, 2, 3, 4, 1000, 2997, 2999, 5000):
            kept = I.incremental_extract(df, "ts", T(2023, 1, 1), limit=cap).count()
            assert kept == min(3000, -(-cap // 3) * 3)
            exact = sorted(r.id for r in I.incremental_extract(df, "ts", T(2023, 1, 1), limit=cap, exact=True, tie_cols=["id"]).collect())
            assert exact == list(range(min(cap, 3000)))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_marks_roundtrip(spark, tmp_dir):
    assert I.read_mark(spark, tmp_dir + "/none", "orders") == I.EPOCH
    I.write_mark(spark, tmp_dir + "/marks", "orders", "garbage")
    assert I.read_mark(spark, tmp_dir + "/marks", "orders") == I.EPOCH
    I.write_mark(spark, tmp_dir + "/marks", "orders", T(2024, 5, 1, 12))
    assert I.read_mark(spark, tmp_dir + "/marks", "orders") == T(2024, 5, 1, 12)


def brute(q, c, k, floor):
    out = {}
    for qi, qv in q.items():
        s = []
        for ci, cv in c.items():
            na, nb = np.linalg.norm(qv), np.linalg.norm(cv)
            if na == 0 or nb == 0:
                continue
            sc = min(float(np.dot(qv, cv) / (na * nb)), 1.0)
            if sc >= floor:
                s.append((-sc, ci))
        out[qi] = [ci for _, ci in sorted(s)[:k]]
    return out


def test_topk_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    cvec = {i: rng.normal(size=8) for i in range(300)}
    cvec[300] = np.zeros(8)                  # zero vector is never returned
    cvec[301] = cvec[5].copy()               # exact tie with 5: smaller id first
    qvec = {i: rng.normal(size=8) for i in range(40)}
    qvec[40] = cvec[5] * 3
    cs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in cvec.items()], "id long, embedding array<float>")
    qs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in qvec.items()], "query_id long, embedding array<float>")
    cf = {r.id: np.array(r.embedding, dtype=np.float64) for r in cs.collect()}
    qf = {r.query_id: np.array(r.embedding, dtype=np.float64) for r in qs.collect()}
    got = VE.vector_topk_batch(qs, cs, "query_id", "id", top_k=4, min_score=0.3,
                               lists=7, list_block_rows=20, broadcast_bytes=0)
    res = {}
    for r in got.orderBy("query_id", "rank").collect():
        res.setdefault(r.query_id, []).append(r.id)
    exp = {q: v for q, v in brute(qf, cf, 4, 0.3).items() if v}
    assert res == exp
    assert res[40][:2] == [5, 301]


def test_chunks_cover_whole_text(spark):
    docs = spark.createDataFrame([(1, "x" * 2500), (2, "short"), (3, "")], "doc_id int, text string")
    ch = VE.chunk_documents(docs, size=1000, overlap=100).orderBy("doc_id", "chunk_index").collect()
    assert [(r.doc_id, r.chunk_index, len(r.content)) for r in ch] == [(1, 0, 1000), (1, 1, 1000), (1, 2, 700), (2, 0, 5)]


def test_rag_pieces(spark):
    chunks = spark.createDataFrame([("c1", "d1", "alpha"), ("c2", "d2", "beta")], "chunk_id string, document_id string, content string")
    res = spark.createDataFrame([("q1", "c2", 1, 0.9), ("q1", "c1", 2, 0.8)], "query_id string, chunk_id string, rank int, score double")
    ctx = R.rag_context(res, chunks, "query_id", "chunk_id").first().context
    assert ctx == "[1] (source: d2)\nbeta\n\n[2] (source: d1)\nalpha\n"
    qs = spark.createDataFrame([("q1", "why?"), ("q2", "how?")], "query_id string, question string")
    conf = {r.query_id: r.confidence for r in R.rag_confidence(qs, res).collect()}
    assert conf == {"q1": 0.85, "q2": 0.0}
    p = {r.query_id: r.prompt for r in R.rag_prompts(qs, R.rag_context(res, chunks, "query_id", "chunk_id")).collect()}
    assert p["q1"].startswith("SYSTEM:\n") and "[1] (source: d2)" in p["q1"] and p["q1"].endswith("HUMAN:\nQuestion: why?")
    assert "Context documents:\n\n" in p["q2"]


def test_parse_and_validate(spark):
    bodies = spark.createDataFrame([
        ('{"choices":[{"text":" a "}]}',), ('{"choices":[{"message":{"content":"b"}}]}',),
        ('{"choices":[{}]}',), ('{"response":"c\\n"}',), ("raw text",)], "body string")
    assert [r.answer for r in R.parse_completions(bodies).collect()] == ["a", "b", "", "c", "raw text"]
    emb = spark.createDataFrame([('{"data":[{"embedding":[1,2]}]}',), ('{"embedding":[3]}',), ('{"x":1}',)], "body string")
    assert [r.vector for r in R.parse_embeddings(emb).collect()] == [[1.0, 2.0], [3.0], None]
    req = spark.createDataFrame([("", None), ("q" * 4097, None), ("ok", 0), ("ok", 51), ("ok", None)],
                                "query string, top_k int")
    out = R.validate_queries(req).collect()
    assert [r.reason for r in out] == ["empty query", "query too long", "top_k out of range", "top_k out of range", None]
    assert out[-1].k == 5


def test_order_id_fallback(spark):
    rows = [(1, "ok", [("o-1", 5.0), ("o-2", 6.0), ("o-1", 7.0)], None, None, None)]
    env = spark.createDataFrame(rows, "page int, status string, data array<struct<order_id:string,amount:double>>, "
                                      "next_page string, next_cursor string, request_cursor string")
    out = CO.collect_pages(env).orderBy("pos").collect()
    assert [(r.id, r.amount) for r in out] == [("o-1", 5.0), ("o-2", 6.0)]


def test_pluggable_items(spark):
    rows = [(1, "ok", '{"items":[{"id":"a"}],"meta":{"next":"2"}}'), (2, "ok", '{"items":[{"id":"b"}],"meta":{}}'),
            (3, "ok", '{"items":[{"id":"c"}]}')]
    env = spark.createDataFrame(rows, "page int, status string, body string")
    items = F.from_json(F.get_json_object("body", "$.items"), "array<struct<id:string>>")
    assert sorted(r.id for r in CO.collect_pages(env, items=items).collect()) == ["a", "b", "c"]


def test_broadcast_and_block_search_agree(spark):
    rng = np.random.default_rng(5)
    cs = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=6)]) for i in range(200)], "id long, embedding array<double>")
    qs = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=6)]) for i in range(30)], "query_id long, embedding array<double>")
    near = lambda bound: sorted(VE.vector_topk_batch(qs, cs, "query_id", "id", top_k=3, min_score=-1.0, lists=5,
                                                     list_block_rows=10, broadcast_bytes=bound).collect())
    assert near(0) == near(1 << 20) and len(near(0)) == 90


def test_rejected_chunks_are_told(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [1.0])], "id int, embedding array<double>")
    good, bad = VE.check_dims(df, 2)
    assert [r.id for r in good.collect()] == [1]
    assert sorted((r.id, r.reason) for r in bad.collect()) == [(2, "no vector"), (3, "wrong width")]


def test_topk_blocks_meet_across_many_partitions(spark):
    """Regression: co-group keys must hash alike on both sides, or blocks miss each other
    once AQE no longer packs everything into one reducer."""
    rng = np.random.default_rng(11)
    cvec = {i: rng.normal(size=6) for i in range(400)}
    qvec = {i: rng.normal(size=6) for i in range(90)}
    cs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in cvec.items()], "id long, embedding array<double>")
    qs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in qvec.items()], "query_id long, embedding array<double>")
    old = (spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled"), spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        got = VE.vector_topk_batch(qs, cs, "query_id", "id", top_k=3, min_score=-1.0,
                                   lists=9, list_block_rows=11, broadcast_bytes=0)
        res = {}
        for r in got.orderBy("query_id", "rank").collect():
            res.setdefault(r.query_id, []).append(r.id)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[0])
        spark.conf.set("spark.sql.shuffle.partitions", old[1])
    assert res == brute(qvec, cvec, 3, -1.0)
