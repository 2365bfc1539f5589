import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.operators import dedup as D

T = dt.datetime


def raw_events(spark):
    at = lambda h, m=0: T(2023, 6, 4, h, m)
    rows = [
        ("a", "ann", "open", 3.0, at(8), 0),
        ("b", "ben", "buy", 20.5, at(9), 1),
        ("a", "ann", "open", 3.0, at(8), 2),   # the first row again
        ("c", "cem", "open", 1.25, at(8, 15), 3),
        ("b", "ben", "buy", 31.0, at(17), 4),  # a later state of b
        ("d", "ann", "buy", 7.0, at(18), 5),
    ]
    return spark.createDataFrame(
        rows, "event_id string, user_id string, event_type string, value double, updated_at timestamp, pos int")


def test_lww_keeps_latest(spark):
    out = {r.event_id: r.value for r in D.dedup_lww(raw_events(spark), "event_id", "updated_at", ["pos"]).collect()}
    assert len(out) == 4 and out["b"] == 31.0


def test_fww_keeps_first(spark):
    out = {r.event_id: r.value for r in D.dedup_fww(raw_events(spark), "event_id", ["pos"]).collect()}
    assert len(out) == 4 and out["b"] == 20.5


def test_exact_tie_keeps_first_input_row(spark):
    rows = D.dedup_lww(raw_events(spark), "event_id", "updated_at", ["pos"]).filter("event_id = 'a'").collect()
    assert [r.pos for r in rows] == [0]


def test_stats(spark):
    s = D.dedup_stats(raw_events(spark), "event_id").first()
    assert (s.input_rows, s.unique_rows, s.duplicate_rows) == (6, 4, 2)
    assert abs(s.pct_reduction - 33.3333) < 1e-3


def test_empty_stats(spark):
    s = D.dedup_stats(raw_events(spark).limit(0), "event_id").first()
    assert (s.input_rows, s.unique_rows, s.duplicate_rows, s.pct_reduction) == (0, 0, 0, 0.0)


def test_null_timestamp_loses_and_null_keys_group(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", T(2024, 1, 1), 2), (None, T(2024, 1, 1), 3), (None, T(2024, 1, 2), 4)],
        "k string, ts timestamp, pos int")
    out = {r.k: r.pos for r in D.dedup_lww(df, "k", "ts", ["pos"]).collect()}
    assert out == {"a": 2, None: 4}
    audit = D.null_key_audit(df, ["k"]).first()
    assert audit.null_k == 2


def test_combine_rejected_and_missing_columns(spark):
    df = raw_events(spark)
    with pytest.raises(ValueError, match="Unsupported"):
        D.dedup(df, "event_id", "updated_at", "combine")
    with pytest.raises(ValueError, match="Missing required columns"):
        D.dedup_lww(df, ["nope"], "updated_at")


def test_dedup_idempotent(spark):
    df = raw_events(spark)
    once = D.dedup_lww(df, "event_id", "updated_at", ["pos"])
    twice = D.dedup_lww(once, "event_id", "updated_at", ["pos"])
    assert sorted(once.collect()) == sorted(twice.collect())


def orders_small(spark):
    return spark.createDataFrame(
        [(11, "uma", 12.0, "new", T(2023, 6, 1, 8)), (12, "vic", 40.25, "new", T(2023, 6, 1, 9)),
         (13, "wes", 9.5, "paid", T(2023, 6, 2, 7))],
        "order_id int, customer string, amount double, status string, updated_at timestamp")


def test_upsert(spark):
    o = orders_small(spark)
    existing = o.filter(F.col("order_id") != 13)
    new = spark.createDataFrame(
        [(12, "vic", 41.0, "paid", T(2023, 6, 3, 9)), (13, "wes", 9.5, "paid", T(2023, 6, 2, 7))], o.schema)
    up = D.upsert_lww(new, existing, "order_id", "updated_at")
    rows = {r.order_id: r for r in up.collect()}
    assert len(rows) == 3
    assert rows[12].amount == 41.0 and rows[12].status == "paid"
    again = D.upsert_lww(new, up, "order_id", "updated_at")
    assert sorted(again.collect()) == sorted(up.collect())


def test_upsert_tie_keeps_existing(spark):
    o = orders_small(spark)
    new = o.withColumn("amount", F.lit(1.0))
    up = {r.order_id: r.amount for r in D.upsert_lww(new, o, "order_id", "updated_at").collect()}
    assert up == {11: 12.0, 12: 40.25, 13: 9.5}


def test_batches_dedup_separately(spark):
    df = raw_events(spark).withColumn("b", F.when(F.col("pos") < 3, 0).otherwise(1))
    out = D.dedup_batches(df, "b", "event_id", "updated_at", ["pos"])
    assert out.count() == 5  # b once per batch, a collapsed in batch 0


def test_dedup_and_write_empty_writes_nothing(spark, tmp_dir):
    assert D.dedup_and_write(raw_events(spark).limit(0), "event_id", tmp_dir) is None
