import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.operators import merge as M

T = dt.datetime


def sides(spark):
    t = spark.createDataFrame([(1, "a", T(2024, 1, 1)), (2, "b", T(2024, 1, 1)), (3, "c", T(2024, 1, 5))],
                              "k int, v string, ts timestamp")
    s = spark.createDataFrame([(2, "B", T(2024, 1, 2)), (3, "C", T(2024, 1, 1)), (4, "D", T(2024, 1, 2))],
                              "k int, v string, ts timestamp")
    return t, s


def test_merge_into_updates_and_inserts(spark):
    t, s = sides(spark)
    out = {r.k: r.v for r in M.merge_into(t, s, "k").collect()}
    assert out == {1: "a", 2: "B", 3: "C", 4: "D"}


def test_merge_only_newer(spark):
    t, s = sides(spark)
    out = {r.k: r.v for r in M.merge_into(t, s, "k", newer_col="ts").collect()}
    assert out == {1: "a", 2: "B", 3: "c", 4: "D"}
    m = M.merge_actions(t, s, "k", newer_col="ts").first()
    assert (m.rows_updated, m.rows_skipped, m.rows_inserted, m.rows_untouched, m.target_rows_after) == (1, 1, 1, 1, 4)
    assert m.valid


def test_update_where_null_predicate_untouched(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 50)], "k int, x int")
    out = {r.k: r.x for r in M.update_where(df, F.col("x") > 10, {"x": F.lit(0)}).collect()}
    assert out == {1: None, 2: 5, 3: 0}


def test_delete_where_null_survives(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 50)], "k int, x int")
    assert sorted(r.k for r in M.delete_where(df, F.col("x") > 10).collect()) == [1, 2]


def test_delete_keys_and_count(spark):
    df = spark.createDataFrame([("d1", 0), ("d1", 1), ("d2", 0)], "document_id string, chunk_index int")
    dl = spark.createDataFrame([("d1",), ("d1",)], "document_id string")
    assert M.delete_keys(df, dl, "document_id").count() == 1
    assert M.deleted_count(df, dl, "document_id").first().deleted_rows == 2


def test_merge_keeps_target_only_columns(spark):
    t = spark.createDataFrame([(1, "a", "keep"), (2, "b", "stay")], "k int, v string, extra string")
    s = spark.createDataFrame([(2, "B", 7), (3, "C", 8)], "k int, v string, added int")
    out = {r.k: tuple(r) for r in M.merge_into(t, s, "k").collect()}
    assert out == {1: (1, "a", "keep", None), 2: (2, "B", "stay", 7), 3: (3, "C", None, 8)}


def test_merge_refuses_double_matches(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "x"), (2, "y"), (9, "n"), (9, "m")], "k int, v string")
    with pytest.raises(Exception, match="several source rows"):
        M.merge_into(t, s, "k").collect()
    assert not M.merge_actions(t, s, "k").first().valid
    fine = M.merge_into(t, s.filter("k = 9"), "k")  # not matched, so both are inserted
    assert sorted(tuple(r) for r in fine.collect()) == [(1, "a"), (2, "b"), (9, "m"), (9, "n")]


def test_null_keys_match_nothing(spark):
    t = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    s = spark.createDataFrame([(None, "x"), (1, "y")], "k int, v string")
    assert sorted((tuple(r) for r in M.merge_into(t, s, "k").collect()), key=repr) == sorted([(None, "a"), (1, "y"), (None, "x")], key=repr)
    assert M.merge_actions(t, s, "k").first().valid


def test_small_source_leaves_the_target_in_place(spark):
    t = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    plan = M.merge_into(t, t.limit(5), "o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
