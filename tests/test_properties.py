"""Property tests: Spark dedup/upsert/version jobs against small pure-pandas models."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewater.operators import dedup as D
from tidewater.operators import versions as V

BASE = dt.datetime(2024, 1, 1)
rows_st = st.lists(
    st.tuples(st.integers(0, 4) | st.none(), st.integers(0, 5) | st.none(), st.integers(0, 100)),
    min_size=0, max_size=25)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def srt(rows):
    return sorted(rows, key=repr)


def frame(spark, rows):
    data = [(k, None if t is None else BASE + dt.timedelta(hours=t), v, i) for i, (k, t, v) in enumerate(rows)]
    return spark.createDataFrame(data, "k int, ts timestamp, v int, pos int")


def model_lww(rows):
    """Sort by key ascending, timestamp descending (missing last), stable; first per key."""
    df = pd.DataFrame(rows, columns=["k", "t", "v"]).reset_index().rename(columns={"index": "pos"})
    df["t"] = df["t"].astype("float")
    df = df.sort_values(["t"], ascending=False, na_position="last", kind="stable")
    df = df.sort_values(["k"], na_position="last", kind="stable")
    return sorted(int(p) for p in df.drop_duplicates(subset=["k"], keep="first")["pos"])


@SETTINGS
@given(rows=rows_st)
def test_lww_matches_model(spark, rows):
    got = sorted(r.pos for r in D.dedup_lww(frame(spark, rows), "k", "ts", ["pos"]).collect())
    assert got == model_lww(rows)


@SETTINGS
@given(rows=rows_st)
def test_stats_and_idempotence(spark, rows):
    df = frame(spark, rows)
    once = D.dedup_lww(df, "k", "ts", ["pos"])
    s = D.dedup_stats(df, "k").first()
    assert s.input_rows == len(rows) and s.unique_rows == once.count()
    assert srt(D.dedup_lww(once, "k", "ts", ["pos"]).collect()) == srt(once.collect())


@SETTINGS
@given(old=rows_st, new=rows_st)
def test_upsert_idempotent(spark, old, new):
    a, b = frame(spark, old), frame(spark, new)
    up = D.upsert_lww(b, a, "k", "ts", ["pos"])
    assert srt(D.upsert_lww(b, up, "k", "ts", ["pos"]).collect()) == srt(up.collect())


@SETTINGS
@given(ops=st.lists(st.tuples(st.integers(1, 4), st.integers(0, 3), st.sampled_from("IUD"), st.integers(0, 9)),
                    min_size=1, max_size=20))
def test_versions_rollback_identity(spark, ops):
    log = spark.createDataFrame(
        [(c, BASE + dt.timedelta(days=c), i, op, k, v) for i, (c, k, op, v) in enumerate(ops)],
        "commit_id int, commit_ts timestamp, seq int, op string, k int, v int")
    for ver in sorted({c for c, *_ in ops}):
        want = srt(V.as_of_version(log, "k", ver).collect())
        assert srt(V.current(V.rollback_to(log, "k", ver), "k").collect()) == want
        assert srt(V.as_of_version(V.expire_versions(log, "k", ver), "k", ver).collect()) == want
