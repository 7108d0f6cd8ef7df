"""Paths the driver fixtures do not reach: composite keys, NULL tracked values, NULL cities."""

import datetime as dt
from decimal import Decimal

from ledgerwarden.operators import scd2
from ledgerwarden.operators.owner import owner_bridge
from ledgerwarden.operators.rules import rule_cities
from ledgerwarden.schemas import (
    ACCOUNTS_HIST,
    CARDS_HIST,
    CLIENTS_HIST,
    TERMINALS_HIST,
    TRANSACTIONS_FACT,
)

T = dt.datetime
FF = dt.datetime(9999, 12, 31)
T0 = T(2024, 1, 1)
RUN = T(2024, 1, 2, 2, 38)


def rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_composite_keys_snapshot_and_cdc(spark):
    schema = "k1 string, k2 int, a string"
    h = scd2.initial_history(spark.createDataFrame([("x", 1, "p"), ("x", 2, "q"), ("y", 1, "r")], schema),
                             ["k1", "k2"], ["a"], T0)
    snap = spark.createDataFrame([("x", 1, "p"), ("x", 2, "Q"), ("z", 9, "n")], schema)
    got = rows(scd2.scd2_merge_snapshot(h, snap, ["k1", "k2"], ["a"], RUN),
               ["k1", "k2", "a", "effective_to", "delete_flg"])
    close = RUN - dt.timedelta(seconds=1)
    assert got == sorted([("x", 1, "p", FF, "N"), ("x", 2, "q", close, "N"), ("x", 2, "Q", FF, "N"),
                          ("y", 1, "r", close, "N"), ("y", 1, "r", FF, "Y"), ("z", 9, "n", FF, "N")], key=repr)
    changes = spark.createDataFrame([("x", 1, "P", T(2024, 1, 2, 10))], "k1 string, k2 int, a string, mod_dt timestamp_ntz")
    got = rows(scd2.scd2_merge(h, changes, ["k1", "k2"], ["a"]), ["k1", "k2", "a", "effective_from"])
    assert ("x", 1, "P", T(2024, 1, 2, 10)) in got and ("x", 2, "q", T0) in got and len(got) == 4


def test_change_log_null_values(spark):
    log = spark.createDataFrame([
        ("k", T(2024, 1, 1), None), ("k", T(2024, 1, 2), None), ("k", T(2024, 1, 3), "v"),
        ("k", T(2024, 1, 4), None), ("j", T(2024, 1, 1), "w")], "key string, ts timestamp_ntz, a string")
    h = scd2.scd2_from_log(log, ["key"], ["a"], "ts", bucket="1 days")
    got = rows(h, ["key", "a", "effective_from", "effective_to"])
    assert got == sorted([("k", None, T(2024, 1, 1), T(2024, 1, 2, 23, 59, 59)),
                          ("k", "v", T(2024, 1, 3), T(2024, 1, 3, 23, 59, 59)),
                          ("k", None, T(2024, 1, 4), FF), ("j", "w", T(2024, 1, 1), FF)], key=repr)


def test_null_city_never_differs(spark):
    hist = lambda schema, data: spark.createDataFrame([r + (T0, FF, "N") for r in data], schema)
    b = owner_bridge(hist(CARDS_HIST, [("C1", "A1")]), hist(ACCOUNTS_HIST, [("A1", dt.date(2030, 1, 1), "K1")]),
                     hist(CLIENTS_HIST, [("K1", "L", "F", "P", None, "P1", dt.date(2030, 1, 1), "+7")]))
    term = hist(TERMINALS_HIST, [("T1", "POS", None, "a"), ("T2", "POS", "B", "b")])
    tx = spark.createDataFrame([("1", T(2024, 1, 5, 10), "C1", "PAYMENT", Decimal(1), "SUCCESS", "T1"),
                                ("2", T(2024, 1, 5, 10, 30), "C1", "PAYMENT", Decimal(1), "SUCCESS", "T2")],
                               TRANSACTIONS_FACT)
    assert rule_cities(tx, term, b).count() == 0


def test_not_in_without_broadcast(spark):
    from ledgerwarden.operators.keys import keys_absent
    left = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    some, with_null = (spark.createDataFrame(x, "r long") for x in ([(2,), (3,)], [(2,), (None,)]))
    got = lambda right: sorted((r.k is not None, r.k) for r in keys_absent(left, right, "k", "r", null_aware=True).collect())
    assert got(some) == [(True, 1)]
    assert got(with_null) == []
    assert got(some.limit(0)) == [(False, None), (True, 1), (True, 2)]
    plan = keys_absent(left, some, "k", "r", null_aware=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "isnull" not in plan.split("LeftAnti")[1].split("\n")[0]


def test_publish_is_whole_or_absent(spark, scratch):
    import datetime as dt
    import os

    import pytest

    from ledgerwarden.plans.state import Warehouse, next_manifest
    wh = Warehouse(spark, f"{scratch}/wh")
    first = next_manifest(wh.latest(), dt.datetime(2021, 3, 1))
    wh.publish(first)
    with pytest.raises(Exception, match="exist"):
        wh.publish(next_manifest(wh.latest().__class__.seed(), dt.datetime(2021, 3, 1)))     # a second publisher of run 1
    runs = wh.root.removeprefix("file:") + "/_runs"
    for broken in ("", '{"run_id": 2, "par'):
        with open(os.path.join(runs, "000000002.json"), "w") as f:
            f.write(broken)
        assert wh.latest().run_id == 1
    wh.publish(next_manifest(wh.latest(), dt.datetime(2021, 3, 2)))
    assert wh.latest().run_id == 2


def test_append_unique_within_the_batch(spark):
    from ledgerwarden.operators.facts import append_unique
    fact = spark.createDataFrame([("1",)], "trans_id string")
    batch = spark.createDataFrame([("1", 1), ("2", 2), ("2", 2), (None, 3), (None, 3)], "trans_id string, n int")
    got = append_unique(fact, batch)
    assert got.columns == batch.columns
    assert sorted((r.trans_id or "", r.n) for r in got.collect()) == [("", 3), ("", 3), ("2", 2)]
