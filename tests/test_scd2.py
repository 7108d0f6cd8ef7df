
import datetime as dt

from pyspark.sql import functions as F

from ledgerwarden.operators import scd2
from ledgerwarden.sources import fixtures as fx
from conftest import SF_MID

T = dt.datetime
FF = dt.datetime(9999, 12, 31)
T0 = T(2024, 1, 1)
RUN = T(2024, 1, 2, 2, 38)
SCHEMA = "k string, a string"


def rows(df):
    return sorted((r.k, r.a, r.effective_from, r.effective_to, r.delete_flg) for r in df.collect())


def start(spark, data):
    return scd2.initial_history(spark.createDataFrame(data, SCHEMA), ["k"], ["a"], T0)


def changes(spark, data):
    return spark.createDataFrame(data, "k string, a string, mod_dt timestamp_ntz")


def keys(spark, ks):
    return spark.createDataFrame([(k,) for k in ks], "k string")


def test_new_changed_deleted_snapshot(spark):
    h = start(spark, [("1", "x"), ("2", "y"), ("3", "z")])
    snap = spark.createDataFrame([("1", "x"), ("2", "Y"), ("4", "w")], SCHEMA)
    got = rows(scd2.scd2_merge_snapshot(h, snap, ["k"], ["a"], RUN))
    close = RUN - dt.timedelta(seconds=1)
    assert got == sorted([
        ("1", "x", T0, FF, "N"),
        ("2", "y", T0, close, "N"), ("2", "Y", RUN, FF, "N"),
        ("3", "z", T0, close, "N"), ("3", "z", RUN, FF, "Y"),
        ("4", "w", RUN, FF, "N")])


def test_null_transitions(spark):
    h = start(spark, [("1", "x"), ("2", None), ("3", None)])
    snap = spark.createDataFrame([("1", None), ("2", "v"), ("3", None)], SCHEMA)
    g = scd2.cogroup_snapshot(h, snap, ["k"], ["a"]).select("k", "action").collect()
    assert sorted((r.k, r.action) for r in g) == [("1", "changed"), ("2", "changed"), ("3", "same")]


def test_change_at_ten_closes_at_nine_59_59(spark):
    h = start(spark, [("1", "x")])
    got = rows(scd2.scd2_merge(h, changes(spark, [("1", "y", T(2024, 1, 2, 10))]), ["k"], ["a"]))
    assert got == [("1", "x", T0, T(2024, 1, 2, 9, 59, 59), "N"), ("1", "y", T(2024, 1, 2, 10), FF, "N")]


def test_key_with_two_versions_vanishes(spark):
    h = start(spark, [("1", "x")])
    h = scd2.scd2_merge(h, changes(spark, [("1", "y", T(2024, 1, 2, 10))]), ["k"], ["a"])
    run = T(2024, 1, 3, 2, 38)
    got = rows(scd2.scd2_merge(h, changes(spark, []), ["k"], ["a"], "mod_dt", keys(spark, []), run))
    assert got == [("1", "x", T0, T(2024, 1, 2, 9, 59, 59), "N"),
                   ("1", "y", T(2024, 1, 2, 10), run - dt.timedelta(seconds=1), "N"),
                   ("1", "y", run, FF, "Y")]


def test_deleted_three_runs_one_marker_and_no_return(spark):
    h = start(spark, [("1", "x"), ("2", "y")])
    for day in range(3):
        run = T(2024, 1, 3 + day)
        h = scd2.scd2_merge(h, changes(spark, []), ["k"], ["a"], "mod_dt", keys(spark, ["2"]), run)
    assert [r for r in rows(h) if r[0] == "1" and r[4] == "Y"] == [("1", "x", T(2024, 1, 3), FF, "Y")]
    back = scd2.scd2_merge(h, changes(spark, [("1", "z", T(2024, 1, 9))]), ["k"], ["a"], "mod_dt",
                           keys(spark, ["1", "2"]), T(2024, 1, 9, 3))
    assert rows(back) == rows(h)
    again = scd2.scd2_merge(h, changes(spark, [("1", "z", T(2024, 1, 9))]), ["k"], ["a"], "mod_dt",
                            keys(spark, ["1", "2"]), T(2024, 1, 9, 3), reopen=True)
    assert ("1", "z", T(2024, 1, 9), FF, "N") in rows(again)


def test_merge_is_idempotent(spark):
    h = start(spark, [("1", "x"), ("2", "y")])
    batch = changes(spark, [("1", "q", T(2024, 1, 2, 10)), ("3", "n", T(2024, 1, 2, 11))])
    once = scd2.scd2_merge(h, batch, ["k"], ["a"])
    twice = scd2.scd2_merge(once, batch, ["k"], ["a"])
    assert rows(once) == rows(twice)
    snap = spark.createDataFrame([("1", "x"), ("4", "w")], SCHEMA)
    s1 = scd2.scd2_merge_snapshot(h, snap, ["k"], ["a"], RUN)
    s2 = scd2.scd2_merge_snapshot(s1, snap, ["k"], ["a"], RUN + dt.timedelta(days=1))
    assert rows(s1) == rows(s2)


def test_latest_change_in_batch_wins(spark):
    h = start(spark, [("1", "x")])
    batch = changes(spark, [("1", "p", T(2024, 1, 2, 9)), ("1", "q", T(2024, 1, 2, 10))])
    assert rows(scd2.scd2_merge(h, batch, ["k"], ["a"])) == [
        ("1", "q", T(2024, 1, 2, 10), FF, "N"), ("1", "x", T0, T(2024, 1, 2, 9, 59, 59), "N")]


def test_invariants_on_fixture_merges(spark):
    h = scd2.initial_history(fx.snapshot_prev(spark, SF_MID), ["k"], ["a", "b"], T0)
    m = scd2.scd2_merge_snapshot(h, fx.snapshot_cur(spark, SF_MID), ["k"], ["a", "b"], RUN)
    assert scd2.scd2_check(m, ["k"]).count() == 0
    o = fx.table(spark, SF_MID, "orders")
    log = scd2.scd2_from_log(o, ["o_custkey"], ["o_orderpriority"], "o_orderdate", ["o_orderkey"])
    assert log.where(F.col("effective_to") == F.lit(FF)).groupBy("o_custkey").count().where("count > 1").count() == 0


def test_snapshot_series_equals_repeated_merges(spark):
    o = fx.table(spark, "/root/testdata/sf0.001", "orders")
    snaps = (o.groupBy(F.date_trunc("year", "o_orderdate").alias("snap_ts"), "o_custkey")
              .agg(F.max("o_orderpriority").alias("p")))
    one_job = scd2.scd2_from_snapshots(snaps, ["o_custkey"], ["p"], "snap_ts")
    dates = sorted(r.snap_ts for r in snaps.select("snap_ts").distinct().collect())
    hist = None
    for d in dates:
        s = snaps.where(F.col("snap_ts") == F.lit(d)).select("o_custkey", "p")
        hist = scd2.initial_history(s, ["o_custkey"], ["p"], d) if hist is None else \
            scd2.scd2_merge_snapshot(hist, s, ["o_custkey"], ["p"], d)
        hist = hist.checkpoint()   # cut lineage in the shared checkpoint folder
    def r(df):
        return sorted(tuple(x) for x in df.select("o_custkey", "p", "effective_from", "effective_to",
                                                  "delete_flg").collect())
    assert r(one_job) == r(hist)


def test_more_dates_than_the_driver_numbers(spark, monkeypatch):
    from ledgerwarden.operators import scd2 as m
    snaps = spark.range(300).select((F.col("id") % 7).cast("string").alias("k"), (F.col("id") % 3).cast("string").alias("a"),
                                    F.expr("timestampadd(DAY, CAST(id div 11 AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("t"))
    snaps = snaps.groupBy("k", "t").agg(F.max("a").alias("a"))
    few = sorted(map(str, m.scd2_from_snapshots(snaps, ["k"], ["a"], "t").collect()))
    monkeypatch.setattr(m, "MAX_DATES", 5)
    assert sorted(map(str, m.scd2_from_snapshots(snaps, ["k"], ["a"], "t").collect())) == few != []
