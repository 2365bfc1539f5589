import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import versionlog as L
from tidewater.operators import versions as V
from tidewater.sources import published as P

SCHEMA = "commit_id bigint, commit_ts timestamp_ntz, seq int, op string, id int, name string, price decimal(8,2)"


def random_log(n_commits, seed=1, first=1):
    rnd = random.Random(seed)
    rows = []
    for c in range(first, first + n_commits):
        for s in range(rnd.randint(1, 12)):
            op = rnd.choice("IUUD")
            rows.append((c * 10, dt.datetime(2024, 1, 1) + dt.timedelta(hours=c), s, op, rnd.randint(0, 25), rnd.choice(["a", None, "ü"]), None))
    return rows


def as_set(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stored_reads_equal_the_full_fold(spark, tmp_dir):
    rows, path = random_log(23), tmp_dir + "/t"
    log = spark.createDataFrame(rows, SCHEMA)
    for low, high in ((0, 50), (50, 60), (60, 150), (150, 1000)):
        L.append_changes(log.filter((F.col("commit_id") > low) & (F.col("commit_id") <= high)), path, ["id"], base_every=4)
    assert L.base_ids(spark, path) == [50, 150, 230]
    for v in (10, 49, 50, 55, 60, 140, 150, 151, 229, 230, 9999):
        assert as_set(L.state(spark, path, ["id"], v)) == as_set(V.as_of_version(log, "id", v)), v
    assert as_set(L.state(spark, path, ["id"])) == as_set(V.current(log, "id"))
    for hours in (1, 6, 20.5):
        ts = str(dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours))
        assert as_set(L.state_at_time(spark, path, ["id"], ts)) == as_set(V.as_of_timestamp(log, "id", ts))
    with pytest.raises(ValueError, match="no commit"):
        L.state(spark, path, ["id"], 9)


def test_a_read_opens_the_base_and_later_commits_only(spark, tmp_dir):
    log, path = spark.createDataFrame(random_log(12), SCHEMA), tmp_dir + "/t"
    for low in range(0, 120, 30):
        L.append_changes(log.filter((F.col("commit_id") > low) & (F.col("commit_id") <= low + 30)), path, ["id"], base_every=3)
    opened = {f.split("/t/")[1].split("/part")[0] for f in L.state(spark, path, ["id"], 80).inputFiles()}
    names = {f.split("/")[0] + " " + next(x for x in f.split("/") if x.startswith(("commit_id", "base_id"))) for f in opened}
    assert names == {"bases base_id=60", "log commit_id=70", "log commit_id=80"}
    exact = {f.split("/t/")[1].split("/")[0] for f in L.state(spark, path, ["id"], 90).inputFiles()}
    assert exact == {"bases"}


def test_rollback_forward_and_expiry(spark, tmp_dir):
    log, path = spark.createDataFrame(random_log(9), SCHEMA), tmp_dir + "/t"
    L.append_changes(log, path, ["id"], base_every=100)
    before, last = as_set(L.state(spark, path, ["id"], 40)), as_set(L.state(spark, path, ["id"]))
    back = L.rollback(spark, path, ["id"], 40, "2024-02-01 00:00:00")
    assert back == 91 and as_set(L.state(spark, path, ["id"])) == before
    L.rollback(spark, path, ["id"], 90, "2024-02-02 00:00:00")
    assert as_set(L.state(spark, path, ["id"])) == last
    kept = {v: as_set(L.state(spark, path, ["id"], v)) for v in (60, 70, 90, 91)}
    L.expire(spark, path, ["id"], 60)
    assert {v: as_set(L.state(spark, path, ["id"], v)) for v in kept} == kept
    assert min(r.commit_id for r in L.commits(spark, path).collect()) == 60
    with pytest.raises(ValueError):
        L.state(spark, path, ["id"], 40)
    L.expire(spark, path, ["id"], 1000)
    assert as_set(L.state(spark, path, ["id"])) == last  # everything folded into the base


def test_only_later_commits_are_taken(spark, tmp_dir):
    path = tmp_dir + "/t"
    L.append_changes(spark.createDataFrame(random_log(3), SCHEMA), path, ["id"])
    for rows in (random_log(1, first=3), [(40, dt.datetime(2023, 1, 1), 0, "I", 1, "x", None)],
                 [(50, dt.datetime(2025, 1, d), d, "I", 1, "x", None) for d in (1, 2)]):
        with pytest.raises(ValueError):
            L.append_changes(spark.createDataFrame(rows, SCHEMA), path, ["id"])
    assert P.version_numbers(spark, path + "/log") == [1]


def test_a_lost_base_is_caught_up(spark, tmp_dir, monkeypatch):
    log, path = spark.createDataFrame(random_log(8), SCHEMA), tmp_dir + "/t"

    def dies(*a):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(L, "write_base", dies)
        with pytest.raises(KeyboardInterrupt):
            L.append_changes(log.filter("commit_id <= 40"), path, ["id"], base_every=2)
    assert L.base_ids(spark, path) == [] and as_set(L.state(spark, path, ["id"])) == as_set(V.as_of_version(log, "id", 40))
    L.append_changes(log.filter("commit_id > 40"), path, ["id"], base_every=2)
    assert L.base_ids(spark, path) == [80] and as_set(L.state(spark, path, ["id"])) == as_set(V.current(log, "id"))
