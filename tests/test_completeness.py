"""Rows and digits that must not get lost: exact amounts, every change of a batch, events without a key."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerwarden.operators import scd2
from ledgerwarden.operators.rules import guessing_hits
from ledgerwarden.schemas import TRANSACTIONS_FACT
from ledgerwarden.sources.feeds import amount_audit, clean_transactions

LOG = "k string, a string, mod_dt timestamp_ntz"
RAW = ("transaction_id string, transaction_date string, amount string, card_num string, oper_type string, "
       "oper_result string, terminal string")


def T(day, hour=0, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


def history(spark, *rows):
    h = spark.createDataFrame([(k, a) for k, a in rows], "k string, a string")
    return scd2.initial_history(h, ["k"], ["a"], T(1))


def shown(df):
    return sorted((r.k, r.a, r.effective_from, r.effective_to, r.delete_flg) for r in df.collect())


def test_amounts_keep_their_digits(spark):
    raw = spark.createDataFrame(
        [(str(i), "2024-01-05 10:00:00", a, "C1", "PAYMENT", "REJECT", "T1") for i, a in enumerate(
            ["123456789012345678,5", "0,0000000001", "10,004", " 7 ", "x", None, "", "1" * 40, "0,00000000005"])], RAW)
    got = [r.amt for r in clean_transactions(raw).orderBy("trans_id").collect()]
    assert got == [Decimal("123456789012345678.5"), Decimal("0.0000000001"), Decimal("10.004"), Decimal(7),
                   None, None, None, None, Decimal("0.0000000001")]
    assert amount_audit(raw).collect()[0].asDict() == {"n_rows": 9, "n_missing": 2, "n_unreadable": 2, "n_rounded": 1}
    assert amount_audit(raw.limit(0)).collect()[0].asDict() == {
        "n_rows": 0, "n_missing": 0, "n_unreadable": 0, "n_rounded": 0}


def test_guessing_sees_steps_of_a_thousandth(spark):
    amounts = ["10,004", "10,003", "10,002", "10,001"]
    raw = spark.createDataFrame(
        [(str(i), f"2024-01-05 10:0{i}:00", a, "C1", "PAYMENT", "SUCCESS" if i == 3 else "REJECT", "T1")
         for i, a in enumerate(amounts)], RAW)
    assert [r.trans_id for r in guessing_hits(clean_transactions(raw)).collect()] == ["3"]


def test_every_change_becomes_a_version(spark):
    hist = history(spark, ("1", "A1"), ("2", "B1"))
    changes = spark.createDataFrame(
        [("1", "A2", T(2)), ("1", "A3", T(3)), ("1", "A3", T(4)), ("3", "N1", T(2)), ("3", "N2", T(5)),
         ("2", "old", T(1)), (None, "x", T(2)), ("2", "x", None),
         ("2", "B2", T(6)), ("2", "B3", T(6))], LOG)          # two at one time: the larger stays
    s = dt.timedelta(seconds=1)
    ff = dt.datetime(9999, 12, 31)
    assert shown(scd2.scd2_merge_log(hist, changes, ["k"], ["a"])) == [
        ("1", "A1", T(1), T(2) - s, "N"), ("1", "A2", T(2), T(3) - s, "N"), ("1", "A3", T(3), ff, "N"),
        ("2", "B1", T(1), T(6) - s, "N"), ("2", "B3", T(6), ff, "N"),
        ("3", "N1", T(2), T(5) - s, "N"), ("3", "N2", T(5), ff, "N")]
    assert scd2.dropped_changes(changes, ["k"]).collect()[0].asDict() == {
        "n_rows": 10, "n_null_key": 1, "n_null_time": 1}


def test_change_log_merge_replays_and_deletes(spark):
    hist = history(spark, ("1", "A1"), ("2", "B1"))
    changes = spark.createDataFrame([("1", "A2", T(2)), ("2", "B2", T(3))], LOG)
    live = spark.createDataFrame([("1",)], "k string")
    once = scd2.scd2_merge_log(hist, changes, ["k"], ["a"], live_keys=live, run_ts=T(9))
    assert [r[:2] + r[4:] for r in shown(once)] == [
        ("1", "A1", "N"), ("1", "A2", "N"), ("2", "B1", "N"), ("2", "B2", "N"), ("2", "B2", "Y")]
    again = scd2.scd2_merge_log(once, changes, ["k"], ["a"], live_keys=live, run_ts=T(10))
    assert shown(again) == shown(once)
    empty = scd2.scd2_merge_log(hist, changes.limit(0), ["k"], ["a"])
    assert shown(empty) == shown(hist)
    assert scd2.scd2_check(once, ["k"]).count() == 0


def test_change_log_merge_equals_the_latest_change_merge(spark):
    hist = history(spark, *[(str(k), f"a{k % 3}") for k in range(40)])
    changes = spark.range(30, 60).select(F.col("id").cast("string").alias("k"),
                                         F.concat(F.lit("a"), F.col("id") % 2).alias("a"),
                                         F.lit(None).cast("timestamp_ntz").alias("mod_dt"))
    changes = changes.withColumn("mod_dt", F.expr("TIMESTAMP_NTZ'2024-01-05 00:00:00'"))
    live = spark.range(5, 55).select(F.col("id").cast("string").alias("k"))
    args = (["k"], ["a"], "mod_dt", live, T(9))
    assert shown(scd2.scd2_merge_log(hist, changes, *args)) == shown(scd2.scd2_merge(hist, changes, *args))


def test_history_from_a_log_against_one_window_per_key(spark):
    log = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 40).cast("string")).alias("k"),
        F.when(F.hash("id") % 5 == 0, F.lit(None)).otherwise(F.pmod(F.hash("id"), F.lit(3)).cast("string")).alias("a"),
        F.expr("timestampadd(HOUR, CAST(pmod(hash(id, 7), 5000) AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("t"),
        F.col("id").alias("n"))
    for bucket in ("1 hour", "2 days", "30 days", "9000 days"):
        got = scd2.scd2_from_log(log, ["k"], ["a"], "t", ["n"], bucket=bucket)
        want = []
        by_key = {}
        for r in sorted(log.collect(), key=lambda r: (r.k, r.t, r.n)):
            by_key.setdefault(r.k, []).append(r)
        for k, rows in by_key.items():
            starts = [r for i, r in enumerate(rows) if i == 0 or rows[i - 1].a != r.a]
            for i, r in enumerate(starts):
                end = starts[i + 1].t - dt.timedelta(seconds=1) if i + 1 < len(starts) else dt.datetime(9999, 12, 31)
                want.append((k, r.a or "", r.t, end))
        assert sorted((r.k, r.a or "", r.effective_from, r.effective_to) for r in got.collect()) == sorted(want)


def test_left_as_of_keeps_events_without_key_or_time(spark):
    events = spark.createDataFrame([("1", T(5), 1), (None, T(5), 2), ("1", None, 3), ("9", T(5), 4), ("1", T(1), 5)],
                                   "k string, at timestamp_ntz, n int")
    hist = scd2.scd2_from_log(spark.createDataFrame([("1", "A1", T(2))], LOG), ["k"], ["a"], "mod_dt")
    got = scd2.scd2_as_of(events, hist, ["k"], "at", ["a"], how="left")
    assert sorted((r.n, r.a) for r in got.collect() if r.a) == [(1, "A1")]
    assert sorted(r.n for r in got.collect()) == [1, 2, 3, 4, 5]
    assert [r.n for r in scd2.scd2_as_of(events, hist, ["k"], "at", ["a"]).collect()] == [1]


def test_fact_amounts_are_wide():
    assert TRANSACTIONS_FACT["amt"].dataType.simpleString() == "decimal(38,10)"
