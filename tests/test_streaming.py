"""Streaming twins equal their batch twins; re-runs are idempotent."""

import datetime as dt
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import dedup as D
from tidewater.plans.collect import build_envelopes
from tidewater.sources import collector as CO
from tidewater.sources.sinks import TEXT_OPTIONS
from tidewater.streaming import jobs as J

SF = "/root/testdata/sf0.001"


def test_stream_upsert_equals_batch_and_is_idempotent(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    landing = tmp_dir + "/landing"
    ev.repartition(4, F.to_date("ts")).write.parquet(landing)
    out = J.stream_upsert(spark, landing, ev.schema, tmp_dir + "/target", tmp_dir + "/ckpt",
                          ["user_id"], "ts", ["event_id"])
    batch = D.dedup_lww(ev, "user_id", "ts", ["event_id"])
    assert sorted(out.collect()) == sorted(batch.collect())
    # same checkpoint, no new files: nothing changes
    again = J.stream_upsert(spark, landing, ev.schema, tmp_dir + "/target", tmp_dir + "/ckpt",
                            ["user_id"], "ts", ["event_id"])
    assert sorted(again.collect()) == sorted(batch.collect())


def test_stream_increment_picks_up_new_files_only(spark, tmp_dir):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    landing = tmp_dir + "/orders"
    o.filter("o_orderdate < '1998-01-01'").write.parquet(landing + "/day1")
    first = J.stream_increment(spark, landing + "/*", o.schema, tmp_dir + "/inc", tmp_dir + "/ckpt")
    n1 = first.count()
    o.filter("o_orderdate >= '1998-01-01'").write.parquet(landing + "/day2")
    second = J.stream_increment(spark, landing + "/*", o.schema, tmp_dir + "/inc", tmp_dir + "/ckpt")
    assert second.count() == o.count() and n1 < o.count()


def test_stream_collect_equals_batch_items(spark, tmp_dir):
    env = build_envelopes(spark.read.parquet(f"{SF}/events.parquet"))
    env.repartition(4, "page").write.options(**TEXT_OPTIONS).json(tmp_dir + "/env")
    got = J.stream_collect(spark, tmp_dir + "/env", tmp_dir + "/items", tmp_dir + "/ckpt")
    items = (env.filter("status = 'ok'").select(F.explode("data").alias("i")).select("i.*")
             .filter("id IS NOT NULL AND id <> ''").distinct())
    assert sorted(got.collect()) == sorted(items.collect())


def test_replayed_epoch_and_folded_log(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    log, how = tmp_dir + "/log", (["user_id"], "ts", ["event_id"])
    for epoch, part in enumerate((ev.filter("event_id % 3 = 0"), ev.filter("event_id % 3 = 1"), ev.filter("event_id % 3 = 2"))):
        J.append_epoch(part, epoch, log, *how)
        J.append_epoch(part, epoch, log, *how)  # the same epoch again
    want = sorted(D.dedup_lww(ev, "user_id", "ts", ["event_id"]).collect())
    assert sorted(J.read_upserted(spark, log, ev.schema, *how).collect()) == want
    folded = J.fold_log(spark, log, tmp_dir + "/folded", ev.schema, *how)
    assert spark.read.parquet(folded).count() == len(want)
    assert sorted(J.read_upserted(spark, folded, ev.schema, *how).collect()) == want


def test_out_of_order_and_repeated_landings(spark, tmp_dir):
    from tests.test_collect_vectors import envelopes

    env = envelopes(spark)
    landing = tmp_dir + "/env"
    for pages in ([3, 5], [1, 2], [3], [4, 1]):
        env.filter(F.col("page").isin(pages)).coalesce(1).write.mode("append").options(**TEXT_OPTIONS).json(landing)
    got = J.stream_collect(spark, landing, tmp_dir + "/items", tmp_dir + "/ckpt")
    assert sorted(r.id for r in got.collect()) == ["a", "b", "c", "z"]
    assert J.late_items(spark, landing, got).count() == 0


def test_late_rows_are_found(spark, tmp_dir):
    from tests.test_collect_vectors import ITEM

    import datetime as dt
    landing = tmp_dir + "/env"
    for page, (i, day) in enumerate([("new", 20), ("newer", 21), ("old", 1)]):
        row = (page, "ok", [(i, 1, "x", 1.0, dt.datetime(2024, 1, day))], None, None, None)
        (spark.createDataFrame([row], f"page int, status string, data array<{ITEM}>, next_page string, next_cursor string, request_cursor string")
         .coalesce(1).write.mode("append").options(**TEXT_OPTIONS).json(landing))
    got = J.stream_collect(spark, landing, tmp_dir + "/items", tmp_dir + "/ckpt", watermark="1 day")
    assert sorted([r.id for r in got.collect()] + [r.id for r in J.late_items(spark, landing, got).collect()]) == ["new", "newer", "old"]


def land(spark, path, page, items):
    """One landed file; items are (id, day, hour)."""
    from tests.test_collect_vectors import ITEM

    rows = [(page, "ok", [(i, n, "x", 1.0, dt.datetime(2024, 1, day, hour)) for n, (i, day, hour) in enumerate(items)], None, None, None)]
    (spark.createDataFrame(rows, f"page int, status string, data array<{ITEM}>, next_page string, next_cursor string, request_cursor string")
     .coalesce(1).write.mode("append").options(**TEXT_OPTIONS).json(path))


def replay(runs, delay, keep):
    """What the stream gives, by a plain walk: runs of batches of (id, time, n)."""
    out, until, watermark, newest = [], {}, None, None
    for batches in runs:
        for batch in [*batches, []]:  # a run ends with a batch that only moves the watermark
            for i, t, n in sorted(batch, key=lambda r: (r[1], r[2])):
                if i in until:
                    continue
                if watermark is not None and t < watermark:
                    out.append((i, t, n, "late"))
                else:
                    until[i] = t + keep
                    out.append((i, t, n, "first"))
            until = {i: u for i, u in until.items() if watermark is None or u > watermark}
            newest = max([t for _, t, _ in batch] + ([newest] if newest else []), default=None)
            watermark = newest - delay if newest else None
    return out, until


def test_first_copies_and_late_rows_in_one_pass(spark, tmp_dir):
    """Against a plain walk over the batches, with a restart in mid-stream; state stays bounded."""
    rnd = random.Random(6)
    runs, page = [], 0
    for _ in range(2):
        batches = []
        for _ in range(5):
            page += 1
            day = 2 + 2 * page
            batches.append([(f"i{rnd.randint(0, 25)}", max(1, day - rnd.choice([0, 0, 0, 1, 4, 9])), rnd.randint(0, 23)) for _ in range(9)])
        runs.append(batches)
    delay, keep = dt.timedelta(days=2), dt.timedelta(days=3)
    plain = [[[(i, dt.datetime(2024, 1, d, h), n) for n, (i, d, h) in enumerate(b)] for b in batches] for batches in runs]
    want, left = replay(plain, delay, keep)
    page = 0
    for batches in runs:
        for b in batches:
            page += 1
            land(spark, tmp_dir + "/env", page, b)
        got, held = J.stream_first_and_late(spark, tmp_dir + "/env", tmp_dir + "/out", tmp_dir + "/ckpt", "2 days", 3 * 86400)
    assert sorted((r.id, r.ts, r.user_id, r.tag) for r in got.collect()) == sorted(want)
    assert {t for *_, t in want} == {"first", "late"} and len(left) == held[-1]
    assert max(held) < len({i for i, *_ in want})  # ids are forgotten


def test_first_or_late_handles_ids_as_a_table_and_replays_an_epoch(spark, tmp_dir):
    """50,000 ids a micro-batch (a Python call per id took minutes); a replayed epoch changes nothing."""
    fields = "id string, user_id bigint, event_type string, value double, ts timestamp_ntz"
    schema = T.StructType([*T.StructType.fromDDL(fields).fields, T.StructField("tag", T.StringType())])
    rows = lambda lo, hi, day: spark.range(lo, hi).selectExpr(
        "CAST(id AS STRING) AS id", "id AS user_id", "'x' AS event_type", "1.0D AS value", f"TIMESTAMP_NTZ '2024-01-{day:02d}' AS ts")
    batches = [rows(0, 50_000, 10).unionByName(rows(0, 50_000, 11)), rows(40_000, 60_000, 12).unionByName(rows(59_990, 60_010, 1))]
    job = J.FirstOrLate(tmp_dir + "/out", tmp_dir + "/state", schema, 0, 86400_000)
    for epoch, batch in enumerate(batches):
        for _ in range(2):
            job.tag(batch, epoch)
    job.close(spark)
    got = spark.read.parquet(tmp_dir + "/out").groupBy("_epoch", "tag").count().collect()
    # of the second batch 40,000 to 49,999 are remembered; old rows are late, also of ids with a timely one
    assert sorted(tuple(r) for r in got) == [(0, "first", 50_000), (1, "first", 10_000), (1, "late", 20)]
    assert job.held == [50_000, 50_000, 10_000, 10_000, 10_000]


def test_rejects_and_accepted_add_up(spark, tmp_dir):
    lines = ['{"page":1,"status":"ok","data":[]}', '{"page":1,"status":"ok","data":[{"id":"a"}]}', '{"page":2,"status":"ok","da', "[]", "null", "7",
             '{"status":"ok","data":[]}', '{"page":"x","status":"ok","data":[]}', '{"page":3,"status":"odd"}', '{"page":4}', '{"page":5,"status":"failed"}',
             '{"page":6,"status":"ok"}', "", "   ", "é ü"]
    for k in range(3):
        spark.createDataFrame([(x,) for x in lines[k::3]], "value string").coalesce(1).write.mode("append").text(tmp_dir + "/in")
    good, bad = CO.read_landing(spark, tmp_dir + "/in")
    assert sorted(r.page for r in good.collect()) == [1, 1, 5]
    reasons = {r.line: r.reason for r in bad.collect()}
    assert len(reasons) == 10 and all(r.file for r in bad.collect())
    assert {reasons[x] for x in ('{"page":2,"status":"ok","da', "é ü", "7", '{"page":"x","status":"ok","data":[]}')} == {"malformed"}
    assert reasons['{"status":"ok","data":[]}'] == "no page" and reasons['{"page":6,"status":"ok"}'] == "no items"
    assert reasons['{"page":3,"status":"odd"}'] == reasons['{"page":4}'] == "unknown status"
    for _ in range(2):  # the second run finds nothing new
        a, r, counts = J.stream_landing(spark, tmp_dir + "/in", tmp_dir + "/out", tmp_dir + "/ckpt")
        assert sorted(x.page for x in a.collect()) == [1, 1, 5] and {x.line: x.reason for x in r.collect()} == reasons
        assert counts.count() == 3 and tuple(counts.groupBy().sum("landed", "accepted", "rejected").first()) == (13, 3, 10)
