"""Plan-shape checks over every registered query (built on the smallest scale factor)."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
# vector scoring, and page text, which neither a regular expression nor a short table can read
PANDAS_OK = {"vector_topk", "vector_topk_pruned", "ivf_recall", "ivf_scored_share", "vector_index_rows", "append_chunks", "vector_topk_batch", "vector_topk_ivf", "rag_context", "rag_prompts", "rag_confidence", "html_text",
             "page_body", "page_metadata", "page_links", "links_out", "crawl_items", "clean_pages"}
NAMES = sorted(n for n in E.queries() if n not in E.LLM_QUERIES)  # those have tests of their own


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join_or_row_python(spark, name):
    plan = plan_text(E.queries()[name](spark, SF))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"
    if name not in PANDAS_OK:
        assert "FlatMapCoGroupsInPandas" not in plan and "ArrowEvalPython" not in plan, name


def test_dedup_limits_before_shuffle(spark):
    plan = plan_text(E.queries()["dedup_lww"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scan_prunes_and_pushes(spark):
    plan = plan_text(E.queries()["incremental_extract"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in plan
    summary = plan_text(E.queries()["dedup_summary"](spark, SF))
    assert "l_tax" not in summary.split("ReadSchema:")[1].split("\n")[0]


def test_a_crawl_round_moves_no_stored_table(spark):
    """Between the scans of edges and of visited pages and their joins there is no exchange."""
    from tidewater.operators import links as L

    edges = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hub' ELSE concat('n', id) END AS src", "concat('n', id + 1) AS dst")
    seeds = spark.createDataFrame([("hub",), ("n7",)], "url string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    tables = L._Bucketed(spark, 8)
    try:
        dealt, hot = L.salted_edges(edges, 100)
        assert [tuple(r) for r in hot.collect()] == [("hub", 10)]
        stored = tables.write(dealt, "edges", ["src", "salt"])
        at_hub = stored.filter("src = 'hub'").groupBy("salt").count().collect()
        assert len(at_hub) == 10 and max(r["count"] for r in at_hub) < 200
        visited = [tables.write(seeds, "depth", ["url"]), tables.write(spark.createDataFrame([("n1",)], "url string"), "depth", ["url"])]
        plan = plan_text(L.next_frontier(visited[0], stored, hot, visited, 8))
        scans = plan.split("\n")
        depth_of = lambda line: len(line) - len(line.lstrip(" :+-"))

        def above(i):
            """Operators between a scan and the nearest join over it."""
            out, at = [], depth_of(scans[i])
            for line in reversed(scans[:i]):
                if depth_of(line) < at:
                    at = depth_of(line)
                    out.append(line.lstrip(" :+-"))
                    if "Join" in line:
                        break
            return out

        bucketed = [i for i, line in enumerate(scans) if "FileScan" in line and "Bucketed: true" in line]
        # the frontier, the edges and both tables of visited pages
        assert len(bucketed) == 4 and not any("Exchange" in op for i in bucketed for op in above(i))
        # what moves: the frontier to its edges, and what it reaches to the visited pages
        assert plan.count("Exchange hashpartitioning(src") == 1 and plan.count("Exchange hashpartitioning(url") == 1
    finally:
        tables.forget()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    got = {r.url: r.depth for r in L.crawl_frontier(edges, seeds, 2, hot_edges=100).collect()}
    succ = {}
    for i in range(3000):
        succ.setdefault("hub" if i % 3 == 0 else f"n{i}", set()).add(f"n{i + 1}")
    want, frontier = {"hub": 0, "n7": 0}, {"hub", "n7"}
    for d in (1, 2):
        frontier = {x for u in frontier for x in succ.get(u, ())} - set(want)
        want |= dict.fromkeys(frontier, d)
    assert got == want
    assert L.crawl_frontier(edges, seeds, 2, max_pages=10).count() == 10
