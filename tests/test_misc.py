import datetime as dt

from pyspark.sql import functions as F

from tidewater.functions import time as TM
from tidewater.functions import urls as U
from tidewater.operators import evolve as E
from tidewater.operators import pages as P
from tidewater.sources import sinks as K


def test_domain_filter(spark):
    urls = ["http://wiki.example.com/a", "https://sub.wiki.example.com:8443/b", "http://example.com/c",
            "http://notwiki.example.com/d", "relative/path"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r.ok for r in df.select(U.in_domains(F.col("u"), ["wiki.example.com"]).alias("ok")).collect()]
    assert got == [True, True, False, False, False]
    assert all(r.ok for r in df.select(U.in_domains(F.col("u"), []).alias("ok")).collect())


def test_host_and_error_stats(spark):
    log = spark.createDataFrame(
        [("http://a.org/x", "ok", None), ("http://a.org/y", "failed", "Timeout"),
         ("https://b.net:8080/", "failed", "DNSLookupError"), ("nohost", "failed", "Timeout")],
        "url string, status string, error_type string")
    hosts = {r.host: (r.requests, r.failures) for r in P.host_stats(log, status_col="status").collect()}
    assert hosts == {"a.org": (2, 1), "b.net:8080": (1, 1), "unknown": (1, 1)}
    errs = {r.error_type: r.errors for r in P.error_stats(log).collect()}
    assert errs == {"Timeout": 2, "DNSLookupError": 1}


def test_parse_timestamp_formats(spark):
    vals = ["2024-01-15T10:00:00Z", "2024-01-15 10:00:00", "2024-01-15", "garbage", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r.t for r in df.select(TM.parse_timestamp(F.col("v")).alias("t")).collect()]
    assert got[:3] == [dt.datetime(2024, 1, 15, 10), dt.datetime(2024, 1, 15, 10), dt.datetime(2024, 1, 15)]
    assert got[3:] == [None, None]
    assert spark.range(1).select(TM.batch_id(F.lit("2024-01-15 10:00:00.123456").cast("timestamp")).alias("b")) \
        .first().b == "20240115_100000_123456"


def test_positional_insert_after_evolution(spark, tmp_dir):
    old = spark.createDataFrame([("e1", "u1", "click", dt.datetime(2024, 1, 1), 1.0)],
                                "event_id string, user_id string, event_type string, event_ts timestamp, amount double")
    evolved = E.evolve_schema(old, [E.AddColumn("region", "string", first=True),
                                    E.AddColumn("country", "string", after="user_id"),
                                    E.RenameColumn("event_type", "action_type"), E.RenameColumn("event_ts", "timestamp"),
                                    E.AddColumn("device_type", "string")])
    spark.sql("DROP TABLE IF EXISTS tw_positional")
    evolved.limit(0).write.option("path", tmp_dir).saveAsTable("tw_positional")
    row = spark.createDataFrame([("eu", "e2", "u2", "DE", "view", dt.datetime(2024, 1, 2), 2.0, "mobile")],
                                "a string, b string, c string, d string, e string, f timestamp, g double, h string")
    K.insert_by_position(row, "tw_positional")
    got = spark.table("tw_positional").first()
    assert (got.region, got.country, got.action_type, got.device_type) == ("eu", "DE", "view", "mobile")
