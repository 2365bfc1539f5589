import datetime as dt

import pytest

from tidewater.operators import evolve as E

T = dt.datetime


def events(spark):
    return spark.createDataFrame(
        [("e1", "u1", "click", T(2024, 1, 1), 1.0), ("e2", "u2", "purchase", T(2024, 1, 2), 20.0),
         ("e3", "u1", "view", T(2024, 1, 3), None)],
        "event_id string, user_id string, event_type string, event_ts timestamp, amount double")


CHANGES = [
    E.AddColumn("session_id", "string"), E.AddColumn("app_version", "string"),
    E.AddColumn("region", "string", first=True), E.AddColumn("country", "string", after="user_id"),
    E.RenameColumn("event_type", "action_type"), E.RenameColumn("event_ts", "timestamp"),
    E.DropColumn("session_id"), E.DropColumn("app_version"), E.AddColumn("device_type", "string"),
]


def test_evolved_order_and_backfill(spark):
    old = events(spark)
    evolved = E.evolve_schema(old, CHANGES)
    assert evolved.columns == ["region", "event_id", "user_id", "country", "action_type", "timestamp",
                               "amount", "device_type"]
    new = spark.createDataFrame([("eu", "e4", "u3", "DE", "click", T(2024, 1, 4), 2.0, "mobile")], evolved.schema)
    both = E.read_versions([(old, CHANGES), (new, [])])
    assert both.count() == 4
    assert E.null_backfill_count(both, "device_type", "action_type", ["click", "purchase", "view"]).first()[0] == 3


def test_widening_rules(spark):
    df = spark.createDataFrame([(1, 1.5)], "a int, b double")
    assert dict(E.widen_column(df, "a", "bigint").dtypes)["a"] == "bigint"
    with pytest.raises(TypeError):
        E.widen_column(df, "b", "string")
    with pytest.raises(TypeError):
        E.widen_column(df, "a", "smallint")


def test_migration_validation(spark, tmp_dir):
    src = spark.createDataFrame(
        [(1, "2024-01-01", "a", "x", 10.0, "COMPLETED"), (2, "2024-01-02", "b", "y", 20.0, "PENDING"),
         (3, "2024-01-03", "c", "z", 30.0, "COMPLETED"), (4, "2024-01-04", "d", "x", 40.0, "CANCELLED"),
         (5, "2024-01-05", "e", "y", 50.0, "COMPLETED")],
        "order_id int, order_date string, customer_name string, product string, amount double, status string")
    tgt = E.migrate_table(spark, src, "tw_test_migrated", tmp_dir, ["status"])
    row = E.validate_migration(src, tgt).first()
    assert row.valid and row.source_rows == row.target_rows == 5
    bad = E.validate_migration(src, tgt.limit(4))
    assert not bad.first().valid


def test_map_columns_are_compared_by_content(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, {"a": "x", "b": "y"}, [{"q": 1}]), (2, None, None)], "k int, m map<string,string>, l array<map<string,int>>")
    turned = spark.createDataFrame([(2, None, None), (1, {"b": "y", "a": "x"}, [{"q": 1}])], df.schema)
    assert E.validate_migration(df, turned).first().valid
    assert not E.validate_migration(df, turned.withColumn("l", F.array(F.create_map(F.lit("q"), F.lit(2))))).first().valid


def test_a_failed_migration_keeps_the_old_table(spark, tmp_dir):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    E.migrate_table(spark, old, "tw_kept", tmp_dir + "/old")
    broken = old.selectExpr("k", "raise_error('broken input') AS v")
    with pytest.raises(Exception, match="broken input"):
        E.migrate_table(spark, broken, "tw_kept", tmp_dir + "/new")
    assert spark.table("tw_kept").count() == 1
    assert E.migrate_table(spark, old.unionByName(old), "tw_kept", tmp_dir + "/third").count() == 2
