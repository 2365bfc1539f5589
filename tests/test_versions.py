import datetime as dt
from decimal import Decimal

from tidewater.operators import versions as V

T = dt.datetime
SCHEMA = ("commit_id int, commit_ts timestamp, seq int, op string, id int, product string, "
          "price decimal(10,2), category string")


def product_log(spark):
    E, F_ = "Electronics", "Furniture"
    rows = []

    def c(cid, changes):
        for i, (op, pid, prod, price, cat) in enumerate(changes):
            rows.append((cid, T(2024, 1, cid), i, op, pid, prod, Decimal(price) if price else None, cat))

    c(1, [("I", 1, "Laptop", "999.99", E), ("I", 2, "Phone", "599.99", E), ("I", 3, "Desk", "299.99", F_)])
    c(2, [("I", 4, "Tablet", "399.99", E), ("I", 5, "Chair", "149.99", F_), ("I", 6, "Lamp", "49.99", F_)])
    c(3, [("U", 1, "Laptop", "899.99", E)])
    c(4, [("U", 3, "Desk", "279.99", F_)])
    c(5, [("D", 5, "Chair", "149.99", F_)])
    # static overwrite: every current row deleted, three Electronics rows written
    c(6, [("D", k, None, None, None) for k in (1, 2, 3, 4, 6)]
      + [("I", 1, "Laptop", "899.99", E), ("I", 2, "Phone", "549.99", E), ("I", 7, "Monitor", "249.99", E)])
    return spark.createDataFrame(rows, SCHEMA)


def test_row_counts_per_version(spark):
    log = product_log(spark)
    assert [V.as_of_version(log, "id", v).count() for v in range(1, 7)] == [3, 6, 6, 6, 5, 3]


def test_time_travel_and_history(spark):
    log = product_log(spark)
    at3 = {r.id: r.price for r in V.as_of_timestamp(log, "id", "2024-01-03 00:00:00").collect()}
    assert at3[1] == Decimal("899.99") and len(at3) == 6
    hist = V.snapshot_history(log).orderBy("commit_id").collect()
    assert [h.parent_id for h in hist] == [None, 1, 2, 3, 4, 5] and hist[-1].is_current


def test_latest_equals_current_and_rollback(spark):
    log = product_log(spark)
    cur = sorted(V.current(log, "id").collect())
    assert cur == sorted(V.as_of_version(log, "id", 6).collect())
    back = V.rollback_to(log, "id", 4)
    assert sorted(V.current(back, "id").collect()) == sorted(V.as_of_version(log, "id", 4).collect())
    # roll forward again is one more compensating commit
    fwd = V.rollback_to(back, "id", 6)
    assert sorted(V.current(fwd, "id").collect()) == cur


def test_diff_and_audit(spark):
    log = product_log(spark)
    d = {r.id: r.operation for r in V.snapshot_diff(V.as_of_version(log, "id", 2),
                                                     V.as_of_version(log, "id", 5), "id").collect()}
    assert d == {1: "update", 3: "update", 5: "delete"}
    audit = V.audit_rows(V.snapshot_diff(V.as_of_version(log, "id", 2), V.as_of_version(log, "id", 5), "id"),
                         "id", "products", "tests").collect()
    ops = {a.record_key: (a.operation, a.new_value is None) for a in audit}
    assert ops["5"] == ("DELETE", True) and ops["1"][0] == "UPDATE"


def test_expire_keeps_later_states(spark):
    log = product_log(spark)
    ex = V.expire_versions(log, "id", 4)
    for v in (4, 5, 6):
        assert sorted(V.as_of_version(ex, "id", v).collect()) == sorted(V.as_of_version(log, "id", v).collect())
    assert ex.filter("commit_id < 4").select("commit_id").distinct().count() == 1
