"""Feeds and extracts: watermark predicate, decimal comma, CSV by position, file choice."""

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerwarden.operators.facts import append_new, append_unique
from ledgerwarden.sources.extract import extract_increment, watermark_advance
from ledgerwarden.sources.feeds import (
    list_files,
    pick_feed,
    read_blacklist,
    read_terminals,
    read_transactions,
)

T = dt.datetime
WM = T(2024, 1, 1)


def src(spark, rows):
    return spark.createDataFrame(rows, "k string, create_dt timestamp_ntz, update_dt timestamp_ntz")


def test_watermark_cases(spark):
    s = src(spark, [("after", T(2024, 1, 2), None), ("equal", WM, None), ("both_null", None, None),
                    ("upd", T(2023, 1, 1), T(2024, 1, 3)), ("old", T(2023, 1, 1), T(2023, 6, 1))])
    got = extract_increment(s, WM, ["k"])
    assert sorted(r.k for r in got.collect()) == ["after", "upd"]
    assert watermark_advance(got, WM).first()[0] == T(2024, 1, 3)
    assert watermark_advance(got.where("false"), WM).first()[0] == WM


def test_extract_filter_reaches_parquet_scan(spark, scratch):
    s = src(spark, [("a", T(2024, 1, 2), None)])
    s.write.parquet(scratch)
    plan = extract_increment(spark.read.parquet(scratch), WM, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_transactions_file_decimal_comma(spark, scratch):
    _write(scratch, "transactions_01032021.txt",
           "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
           "0001;2021-03-01 00:00:01;100,50;C1 ;PAYMENT;SUCCESS;T,1\n"
           "0002;2021-03-01 00:00:02;bad;C2;WITHDRAW;REJECT;T2\n")
    rows = read_transactions(spark, scratch).orderBy("trans_id").collect()
    assert rows[0].trans_id == "0001" and rows[0].amt == Decimal("100.50")
    assert rows[0].card_num == "C1" and rows[0].terminal == "T,1"
    assert rows[1].amt is None


def test_sheets_by_position(spark, scratch):
    _write(scratch + "/t", "terminals_01032021.csv", "id,type,city,address\nT1,POS,Moscow,Street 1\n")
    _write(scratch + "/b", "passport_blacklist_01032021.csv", "date,passport\n2021-03-01,P1\n")
    t = read_terminals(spark, scratch + "/t").collect()[0]
    b = read_blacklist(spark, scratch + "/b").collect()[0]
    assert (t.terminal_id, t.terminal_city) == ("T1", "Moscow")
    assert (b.passport_num, b.entry_dt) == ("P1", dt.date(2021, 3, 1))


def test_feed_pick_by_name_and_by_date(spark, scratch):
    for n in ["transactions_02032021.txt", "transactions_01042021.txt", "terminals_01032021.xlsx", "x.txt"]:
        _write(scratch, n, "")
    got = {r.feed: r for r in pick_feed(list_files(spark, scratch), ["transactions", "terminals", "blacklist"]).collect()}
    assert got["transactions"].first_by_name == "transactions_01042021.txt"   # the reference's choice
    assert got["transactions"].first_by_date == "transactions_02032021.txt"
    assert "blacklist" not in got


def test_blacklist_first_entry_wins(spark):
    fact = spark.createDataFrame([("P1", dt.date(2024, 1, 1))], "passport_num string, entry_dt date")
    batch = spark.createDataFrame([("P1", dt.date(2024, 1, 5)), ("P2", dt.date(2024, 1, 7)),
                                   ("P2", dt.date(2024, 1, 6))], "passport_num string, entry_dt date")
    assert sorted(tuple(r) for r in append_new(fact, batch).collect()) == [("P2", dt.date(2024, 1, 6))]


def test_transactions_unique_append(spark):
    fact = spark.createDataFrame([("1",)], "trans_id string")
    batch = spark.createDataFrame([("1",), ("2",)], "trans_id string")
    assert [r.trans_id for r in append_unique(fact, batch).collect()] == ["2"]


def test_transactions_local_time_format(spark, scratch):
    _write(scratch, "transactions_01032021.txt",
           "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
           "7;01.03.2021 10:15:30;5,00;C1;PAYMENT;SUCCESS;T1\n"
           "8;not a time;5,00;C1;PAYMENT;SUCCESS;T1\n")
    rows = read_transactions(spark, scratch, ts_format="dd.MM.yyyy HH:mm:ss").orderBy("trans_id").collect()
    assert rows[0].trans_date == T(2021, 3, 1, 10, 15, 30) and rows[1].trans_date is None


def test_wall_clock_ignores_session_zone(spark):
    from ledgerwarden.sources.feeds import wall_clock
    df = spark.createDataFrame([("10.03.2024 02:30:00", "2024-03-10 02:30:00.5")], "a string, b string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")   # 02:30 does not exist there
        r = df.select(wall_clock(F.col("a"), "dd.MM.yyyy HH:mm:ss").alias("a"), wall_clock(F.col("b")).alias("b")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert r.a == T(2024, 3, 10, 2, 30) and r.b == T(2024, 3, 10, 2, 30, 0, 500000)
