"""Decision cases from the survey (D3, D4, D6, D7) on hand-made fixtures."""

import datetime as dt
from decimal import Decimal


from tidewater.operators import pages as P
from tidewater.operators import vectors as VE
from tidewater.sources import sinks as K

SCHEMA = "id int, product string, price decimal(10,2), category string, updated_at timestamp"


def test_overwrite_scope_static_vs_dynamic(spark, tmp_dir):
    t = dt.datetime(2024, 1, 1)
    base = spark.createDataFrame(
        [(1, "Laptop", Decimal("899.99"), "Electronics", t), (2, "Phone", Decimal("599.99"), "Electronics", t),
         (3, "Desk", Decimal("279.99"), "Furniture", t), (4, "Tablet", Decimal("399.99"), "Electronics", t),
         (6, "Lamp", Decimal("49.99"), "Furniture", t)], SCHEMA)
    batch = spark.createDataFrame(
        [(1, "Laptop", Decimal("899.99"), "Electronics", t), (2, "Phone", Decimal("549.99"), "Electronics", t),
         (7, "Monitor", Decimal("249.99"), "Electronics", t)], SCHEMA)
    static, dynamic = tmp_dir + "/static", tmp_dir + "/dynamic"
    for path in (static, dynamic):
        K.overwrite_static(base, path, ["category"])
    K.overwrite_static(batch, static, ["category"])
    K.overwrite_partitions(batch, dynamic, ["category"])
    assert spark.read.parquet(static).count() == 3
    ids = sorted(r.id for r in spark.read.parquet(dynamic).collect())
    assert ids == [1, 2, 3, 6, 7]   # Furniture (3, 6) survives a dynamic overwrite


def test_html_sniff_needs_exact_markers(spark):
    items = spark.createDataFrame(
        [("<p class='x'>kept   as\ttext</p>", "t"), ("<P>upper</P>", "t"), ("<span>x</span> y", "t")],
        "content string, title string")
    out = [r.content for r in P.clean_items(items, "2024-01-01").collect()]
    assert out == ["<p class='x'>kept as text</p>", "upper", "x y"]


def test_vector_floor_inclusive_and_default_k(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, embedding array<double>")
    c = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(8)] + [(99, [0.0, 0.0])],
                              "id int, embedding array<double>")
    # cos(q, [1, 1]) = 0.7071...; floor set exactly at that value keeps the chunk
    floor = 1 / (2 ** 0.5)
    got = VE.vector_topk_batch(q, c, "query_id", "id", top_k=0, min_score=floor).orderBy("rank").collect()
    assert [r.id for r in got] == [0, 1]
    assert [r.score for r in got] == [1.0, round(floor, 6)]
    many = VE.vector_topk_batch(q, c, "query_id", "id", top_k=None, min_score=0.0).count()
    assert many == VE.DEFAULT_TOP_K   # zero vector never returned, default k applied
