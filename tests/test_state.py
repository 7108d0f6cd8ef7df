"""Run log, ledger, refused rows, day index and key filters of the warehouse."""

import datetime as dt
import json
import os
import shutil

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_daily import feeds, with_audit
from test_streaming import land

from ledgerwarden.plans import keyfilters
from ledgerwarden.plans.daily import DayFeeds, RunOptions, run_day
from ledgerwarden.plans.incremental import INDEX_BUCKETS, index_rows, indexed_days, report_scope
from ledgerwarden.plans.state import CHECKPOINT_EVERY, DAY, Warehouse, next_manifest
from ledgerwarden.schemas import CARDS_HIST, REPORT, TRANSACTIONS_FACT, TRANSACTIONS_RAW
from ledgerwarden.sources import fixtures as fx
from ledgerwarden.streaming import run_on_arrival

D, TS = dt.date, dt.datetime


def plain(m):
    return {k: v for k, v in m.__dict__.items() if k not in ("base", "ledger")}


def test_many_runs_from_the_log_and_from_whole_states(spark, scratch):
    wh, runs = Warehouse(spark, f"{scratch}/wh"), 120
    m = wh.latest()
    for i in range(1, runs + 1):
        m = next_manifest(m, TS(2024, 1, 1) + dt.timedelta(days=i))
        t = m.tables.setdefault("transactions", {"parts": []})
        t["parts"] = ([f"all-{i}"] if i % 50 == 0 else [*t["parts"], f"part-{i}"])      # now and then compacted
        c = m.tables.setdefault("cards", {"closed": [], "current": None})
        c["closed"], c["current"] = [*c["closed"], f"closed-{i}"], f"open-{i}"
        m.watermarks["cards"] = f"2024-01-01 00:00:{i % 60:02d}"
        wh.publish(m)
    folder = wh.root.removeprefix("file:") + "/_runs"
    sizes = [os.path.getsize(f"{folder}/{i:09d}.json") for i in (3, 40, runs - 1)]
    assert max(sizes) < 1.2 * min(sizes)                                # a record does not grow with the runs
    assert plain(wh.latest()) == plain(wh.state(runs)) == plain(wh.state(runs, checkpoints=False)) == plain(m)
    whole = runs - runs % CHECKPOINT_EVERY
    with open(f"{folder}/_whole/{whole:09d}.json", "w") as f:           # a broken whole state: further back
        f.write('{"run_id": ')
    assert plain(wh.latest()) == plain(m)
    for tail in ("", '{"run_id": 121, "changes"', json.dumps({"run_id": 7, "changes": {}})):
        with open(f"{folder}/{runs + 1:09d}.json", "w") as f:
            f.write(tail)
        assert wh.latest().run_id == runs
    again = next_manifest(wh.latest(), TS(2025, 1, 1))
    wh.publish(again)                                                   # the broken record is replaced
    assert plain(wh.latest()) == plain(again)


def test_a_state_from_before_the_log_goes_on(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    folder = wh.root.removeprefix("file:") + "/_runs"
    os.makedirs(folder)
    old = {"run_id": 1, "parent": 0, "run_ts": "2024-01-01 00:00:00", "report_date": "2021-03-02", "attempt": "x",
           "watermarks": {"cards": "2024-01-01 00:00:00"}, "tables": {}, "consumed_files": ["a.txt"], "report_basis": "b"}
    with open(f"{folder}/000000001.json", "w") as f:
        json.dump(old, f)
    m = wh.latest()
    assert m.consumed_files == ["a.txt"] and not m.indexed
    with pytest.raises(ValueError, match="a.txt"):
        run_day(wh, DayFeeds(files=["a.txt", "b.txt"]), TS(2024, 1, 3))
    m = run_day(wh, DayFeeds(files=["b.txt"]), TS(2024, 1, 3))
    assert m.consumed_files == ["a.txt", "b.txt"] == wh.latest().consumed_files and m.indexed


def test_files_are_in_the_ledger_not_in_the_record(spark, scratch):
    sizes = []
    for n in (1, 400):
        wh = Warehouse(spark, f"{scratch}/{n}")
        run_day(wh, DayFeeds(files=[f"f{i:05d}.txt" for i in range(n)]), TS(2024, 1, 3))
        sizes.append(os.path.getsize(wh.root.removeprefix("file:") + "/_runs/000000001.json"))
        assert len(wh.latest().consumed_files) == n
        with pytest.raises(ValueError, match="consumed"):
            run_day(wh, DayFeeds(files=["new.txt", "f00000.txt"]), TS(2024, 1, 4))
    assert abs(sizes[0] - sizes[1]) < 50


# --- refused rows ------------------------------------------------------------------------

def test_refused_rows_are_kept_and_counted(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    raw = spark.createDataFrame([
        ("1", "2024-01-05 10:00:00", "10,5", "C1 ", "PAYMENT", "SUCCESS", "T1"),
        ("2", "2024-01-05 11:00:00", "abc", "C1", "PAYMENT", "SUCCESS", "T1"),
        (" ", "2024-01-05 11:00:00", "1", "C1", "PAYMENT", "SUCCESS", "T1"),
        (None, None, "x", None, None, None, None), ("4", "", "1", "C1", None, None, None),
        ("5", "05.01.2024", "1", "C1", None, None, None), ("6", "2024-01-06 00:00:00", None, "C2", None, None, None),
        ("7", "2024-01-06 00:00:00", "0,12345678901", "C2", None, None, None)], TRANSACTIONS_RAW)
    cards = with_audit(spark.createDataFrame([("C1", "A1"), (None, "A2")], "card_num string, account string"))
    untimed = cards.withColumn("create_dt", F.lit(None).cast("timestamp_ntz")).withColumn("card_num", F.lit("C9"))
    terminals = spark.createDataFrame([("T1", "a", "b", "c"), (None, "a", "b", "c")],
                                      "terminal_id string, terminal_type string, terminal_city string, terminal_address string")
    bl = spark.createDataFrame([("P1", D(2024, 1, 1)), (None, D(2024, 1, 2))], "passport_num string, entry_dt date")
    m = run_day(wh, DayFeeds(cards=cards.unionByName(untimed), terminals=terminals, blacklist=bl, transactions_raw=raw), TS(2024, 1, 7))
    assert m.counts["transactions"] == {"null_key": 2, "null_time": 1, "unreadable_time": 1, "unreadable_amount": 1, "rounded_amount": 1}
    assert m.counts["cards"] == {"null_key": 1, "null_time": 2} and m.counts["terminals"] == m.counts["blacklist"] == {"null_key": 1}
    assert wh.latest().counts == m.counts
    assert sorted(r.trans_id for r in wh.fact(m, "transactions", TRANSACTIONS_FACT).collect()) == ["1", "6", "7"]
    told = wh.rejected(m).collect()
    assert sorted((r.source, r.reason) for r in told if r.source != "transactions") == [
        ("blacklist", "null_key"), ("cards", "null_key"), ("cards", "null_time"), ("cards", "null_time"), ("terminals", "null_key")]
    bad = [json.loads(r.row) for r in told if r.reason == "unreadable_amount"]
    assert [(b["transaction_id"], b["amount"], b["terminal"]) for b in bad] == [("2", "abc", "T1")]
    assert wh.history(m, "cards", CARDS_HIST).count() == 1
    clean = run_day(wh, DayFeeds(transactions_raw=raw.where("transaction_id = '1'")), TS(2024, 1, 8))
    assert clean.counts.get("transactions") == {} and wh.rejected(clean).count() == len(told)
    assert wh.fact(clean, "transactions", TRANSACTIONS_FACT).count() == 4
    everything = run_day(wh, DayFeeds(transactions_raw=raw.where("transaction_id = '2'")), TS(2024, 1, 9))
    assert wh.fact(everything, "transactions", TRANSACTIONS_FACT).count() == 4      # nothing loaded
    off = run_day(Warehouse(spark, f"{scratch}/off"), DayFeeds(cards=cards), TS(2024, 1, 7), RunOptions(quarantine=False))
    assert off.counts["cards"] == {}


def test_undated_file_is_quarantined_once(spark, scratch):
    src, wh = f"{scratch}/in", Warehouse(spark, f"{scratch}/wh")
    land(src, "transactions_extra.txt", ["1;2021-03-01 10:00:00;10,5;C1;PAYMENT;SUCCESS;T1\n"])
    land(src, "transactions_01032021.txt", ["2;2021-03-01 10:00:00;10,5;C1;PAYMENT;SUCCESS;T1\n"])
    for _ in range(2):
        run_on_arrival(spark, src, wh, checkpoint=f"{scratch}/ck", undated="quarantine")
    m = wh.latest()
    assert (m.run_id, m.report_date, m.counts["transactions"]) == (2, "2021-03-02", {"undated_file": 1})
    assert [(r.reason, json.loads(r.row)["transaction_id"]) for r in wh.rejected(m).collect()] == [("undated_file", "1")]
    assert [f.rsplit("/", 1)[1] for f in m.consumed_files] == ["transactions_01032021.txt"]
    land(src, "transactions_02032021.txt", ["3;2021-03-02 10:00:00;10,5;C1;PAYMENT;SUCCESS;T1\n"])
    run_on_arrival(spark, src, wh, checkpoint=f"{scratch}/ck")                  # does not block, even where undated files raise
    assert wh.fact(wh.latest(), "transactions", TRANSACTIONS_FACT).count() == 2
    shutil.rmtree(f"{scratch}/ck/landing".removeprefix("file:"))                # nothing new: no landed row is read
    run_on_arrival(spark, src, wh, checkpoint=f"{scratch}/ck")
    assert wh.latest().run_id == 3
    with pytest.raises(ValueError):
        run_on_arrival(spark, src, wh, checkpoint=f"{scratch}/ck", undated="ignore")


# --- day index ----------------------------------------------------------------------------

def test_a_changed_terminal_reads_the_days_it_touches(spark, scratch):
    wh = Warehouse(spark, scratch)
    tx = fx.transactions(spark, SF_SMALL)
    opt = RunOptions(null_safe_report=True)
    terminals = fx.terminals(spark, SF_SMALL)
    run_day(wh, feeds(spark, tx, ["transactions_31012024.txt"]), TS(2024, 2, 1), opt)
    rare = spark.createDataFrame([("9001", TS(2024, 3, 5, 10), "C1", "PAYMENT", None, "SUCCESS", "TX"),
                                  ("9002", TS(2024, 5, 5, 10), "C1", "PAYMENT", None, "SUCCESS", "T1")], TRANSACTIONS_FACT)
    run_day(wh, DayFeeds(transactions=rare), TS(2024, 6, 1), opt)
    prev = wh.latest()
    more = terminals.unionByName(spark.createDataFrame([("TX", "ATM", "Here", "x")], terminals.schema))
    m = run_day(wh, DayFeeds(terminals=more), TS(2024, 6, 2), opt)
    scope, days = report_scope(wh, prev, m, [opt.cities_within, opt.guessing_within])
    assert days == [(D(2024, 3, 4), D(2024, 3, 6))]
    assert [r.trans_id for r in scope.collect()] == ["9001"]
    plan = scope._jdf.queryExecution().executedPlan().toString()
    reads = [x for x in plan.split("PartitionFilters: ")[1:]]
    assert any(DAY in x.split("]")[0] for x in reads) and any("bucket" in x.split("]")[0] and "kind" in x.split("]")[0] for x in reads)
    prior = wh.fact(prev, "report", REPORT, where=F.col(DAY) == F.lit(D(2024, 3, 5)))
    assert f"PartitionFilters: [isnotnull({DAY}" in prior._jdf.queryExecution().executedPlan().toString()


def test_index_holds_every_terminal_card_and_day(spark, scratch):
    wh = Warehouse(spark, scratch)
    tx = fx.transactions(spark, SF_SMALL, True)
    m = run_day(wh, DayFeeds(transactions=tx), TS(2024, 2, 1))
    want = {(r.card_num.strip(), r.trans_date.date()) for r in tx.where("terminal = 'T3'").collect()}
    keys = spark.createDataFrame([("T3",)], "key string")
    assert {tuple(r) for r in indexed_days(wh, m, "terminal", keys).collect()} == want
    one = tx.first().card_num.strip()
    got = indexed_days(wh, m, "card", spark.createDataFrame([(one,)], "key string")).collect()
    assert {tuple(r) for r in got} == {(one, r.trans_date.date()) for r in tx.where(F.trim("card_num") == one).collect()}
    assert index_rows(tx.limit(0)).count() == 0
    assert index_rows(tx).select("bucket").distinct().count() <= INDEX_BUCKETS


def test_null_safe_reports_are_incremental_by_default():
    assert RunOptions().incremental is None
    assert RunOptions(distinct_report=True).basis() != RunOptions().basis()


# --- key filters -----------------------------------------------------------------------------

def batch(spark, keys):
    return spark.createDataFrame([(k, TS(2024, 1, 5), "C1", "PAYMENT", None, "SUCCESS", "T1") for k in keys], TRANSACTIONS_FACT)


def test_only_folders_that_may_hold_a_key_are_read(spark, scratch):
    wh, opt = Warehouse(spark, scratch), RunOptions(unique_transactions=True)
    loads = [[str(i) for i in range(0, 3000, 3)], [str(i) for i in range(1, 3000, 3)], [f"x{i}" for i in range(500)], [None, None]]
    for i, keys in enumerate(loads):
        run_day(wh, DayFeeds(transactions=batch(spark, keys)), TS(2024, 2, 1 + i), opt)
    m = wh.latest()
    parts = m.tables["transactions"]["parts"]

    def folders(keys):
        return [parts.index(p) for p in keyfilters.folders_with(wh, m, "transactions", batch(spark, keys))]

    assert folders(["3"]) == [0] and folders(["4"]) == [1] and folders(["x7"]) == [2]
    assert folders(["3", "x499", "4", None]) == [0, 1, 2] and folders([None]) == [] and folders(["5", "2"]) == []
    assert folders(["99999999"]) == [] and folders([str(i) for i in range(0, 3000, 30)]) == [0]
    got = run_day(wh, DayFeeds(transactions=batch(spark, ["3", "5", "5", None, "x1", "x777"])), TS(2024, 3, 1), opt)
    new = wh.added(m, got, "transactions", TRANSACTIONS_FACT)
    assert sorted((r.trans_id or "" for r in new.collect())) == ["", "5", "x777"]
    plainly = run_day(wh, DayFeeds(transactions=batch(spark, ["800000"])), TS(2024, 3, 2))          # without a filter
    assert len(keyfilters.folders_with(wh, plainly, "transactions", batch(spark, ["5000000"]))) == 1


def test_one_scan_of_a_source_gives_changes_live_keys_and_refused_rows(spark, scratch):
    from ledgerwarden.operators.scd2 import scd2_cdc_delta
    from ledgerwarden.sources.extract import source_changes
    rows = spark.createDataFrame([("1", "A1", TS(2024, 1, 1), None), ("2", "A2", TS(2024, 1, 1), TS(2024, 1, 9)), ("3", "A3", None, None),
                                  (None, "A4", TS(2024, 1, 9), None), (None, "A4", TS(2024, 1, 9), None), (None, "A5", TS(2024, 1, 1), None),
                                  ("6", "A6", TS(2024, 1, 8), None)],
                                 "card_num string, account_num string, create_dt timestamp_ntz, update_dt timestamp_ntz")
    rows.write.parquet(f"{scratch}/src")
    src = spark.read.parquet(f"{scratch}/src")
    hist = spark.createDataFrame([(k, f"old{k}", TS(2024, 1, 2), TS(9999, 12, 31), "N") for k in ("1", "2", "3", "4")], CARDS_HIST)
    changes = source_changes(src, ["card_num"], ["card_num", "account_num"], TS(2024, 1, 5))
    delta = scd2_cdc_delta(hist, changes, ["card_num"], ["account_num"], run_ts=TS(2024, 1, 10), whole=True)
    got = [(r["_part"], r.card_num, r.account_num, r.delete_flg) for r in delta.collect()]
    assert sorted(got, key=str) == sorted([
        (None, "1", "old1", "N"), (None, "2", "old2", "N"), (None, "2", "A2", "N"), (None, "3", "old3", "N"),
        (None, "4", "old4", "N"), (None, "4", "old4", "Y"), (None, "6", "A6", "N"),
        ("null_time", None, None, None), ("null_key", None, None, None), ("null_key", None, None, None)], key=str)
    assert delta.select("*")._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert src.count() == 7 and source_changes(src, ["card_num"], ["card_num"], TS(2024, 1, 5), False).count() == 4


def test_compaction_keeps_key_filters(spark, scratch):
    from ledgerwarden.plans.state import compact
    wh, opt = Warehouse(spark, scratch), RunOptions(unique_transactions=True)
    for i, keys in enumerate((["1", "2"], ["5", "6"])):
        run_day(wh, DayFeeds(transactions=batch(spark, keys)), TS(2024, 2, 1 + i), opt)
    m = compact(wh, "transactions", TRANSACTIONS_FACT)
    assert len(wh.latest().tables[keyfilters.FILTERS]["parts"]) == 1
    assert keyfilters.folders_with(wh, m, "transactions", batch(spark, ["3"])) == []
    assert keyfilters.folders_with(wh, m, "transactions", batch(spark, ["3", "6"])) == m.tables["transactions"]["parts"]
    after = run_day(wh, DayFeeds(transactions=batch(spark, ["6", "7"])), TS(2024, 3, 1), opt)
    assert sorted(r.trans_id for r in wh.fact(after, "transactions", TRANSACTIONS_FACT).collect()) == ["1", "2", "5", "6", "7"]


def test_a_run_of_empty_feeds(spark, scratch):
    wh = Warehouse(spark, scratch)
    cards = with_audit(spark.createDataFrame([], "card_num string, account string"))
    bl = spark.createDataFrame([], "passport_num string, entry_dt date")
    raw = spark.createDataFrame([], TRANSACTIONS_RAW)
    for i, opt in enumerate((RunOptions(), RunOptions(null_safe_report=True, unique_transactions=True), RunOptions(every_change=True))):
        m = run_day(wh, DayFeeds(cards=cards, blacklist=bl, transactions_raw=raw), TS(2024, 1, 7 + i), opt)
        assert m.run_id == i + 1 and not any(m.counts.values())
    assert wh.fact(m, "transactions", TRANSACTIONS_FACT).count() == 0 and wh.rejected(m).count() == 0
