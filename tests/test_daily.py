"""Two daily runs through the warehouse equal the operators applied directly."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerwarden.operators.owner import owner_bridge
from ledgerwarden.operators.report import fraud_report
from ledgerwarden.plans.daily import DayFeeds, RunOptions, run_day
from ledgerwarden.plans.state import Warehouse
from ledgerwarden.sources import fixtures as fx
from conftest import SF_SMALL

CUT = dt.datetime(2024, 1, 16)
RUN1 = dt.datetime(2024, 1, 16, 2, 38)
RUN2 = dt.datetime(2024, 1, 31, 2, 38)


def with_audit(df, created=dt.datetime(2023, 12, 1)):
    return df.withColumn("create_dt", F.lit(created).cast("timestamp_ntz")).withColumn(
        "update_dt", F.lit(None).cast("timestamp_ntz"))


def feeds(spark, tx, files):
    return DayFeeds(
        cards=with_audit(fx.cards(spark, SF_SMALL).withColumnRenamed("account_num", "account")),
        accounts=with_audit(fx.accounts(spark, SF_SMALL).withColumnRenamed("account_num", "account")),
        clients=with_audit(fx.clients(spark, SF_SMALL)),
        terminals=fx.terminals(spark, SF_SMALL),
        blacklist=fx.blacklist(spark, SF_SMALL),
        transactions=tx, files=files)


def test_two_days(spark, scratch):
    wh = Warehouse(spark, scratch)
    tx = fx.transactions(spark, SF_SMALL)
    opt = RunOptions(guessing_within="3 days")
    m1 = run_day(wh, feeds(spark, tx.where(F.col("trans_date") < F.lit(CUT)), ["transactions_15012024.txt"]),
                 RUN1, opt)
    m2 = run_day(wh, feeds(spark, tx.where(F.col("trans_date") >= F.lit(CUT)), ["transactions_30012024.txt"]),
                 RUN2, opt)
    assert (m1.run_id, m2.run_id) == (1, 2)
    assert m1.watermarks["cards"] == "2023-12-01 00:00:00"      # max modification time seen
    assert m2.watermarks["cards"] == "2023-12-01 00:00:00"      # nothing new: unchanged
    assert m2.report_date == "2021-03-03"
    # Unchanged dimensions: no new versions on day 2.
    assert wh.history(m2, "cards", __import__("ledgerwarden.schemas", fromlist=["x"]).CARDS_HIST).count() == \
        fx.cards(spark, SF_SMALL).count()
    # Report = day-1 report + the next day's new rows, computed directly.
    br = owner_bridge(fx.cards(spark, SF_SMALL), fx.accounts(spark, SF_SMALL), fx.clients(spark, SF_SMALL),
                      fx.blacklist(spark, SF_SMALL))
    term = fx.terminals(spark, SF_SMALL)
    day1 = fraud_report(tx.where(F.col("trans_date") < F.lit(CUT)), term, br, guessing_within="3 days")
    day2 = fraud_report(tx, term, br, prior=day1, guessing_within="3 days",
                        report_dt=dt.date(2021, 3, 2))
    expect = sorted(tuple(r) for r in day1.unionByName(day2).collect())
    from ledgerwarden.schemas import REPORT
    got = sorted(tuple(r) for r in wh.fact(m2, "report", REPORT).collect())
    assert got == expect
    with pytest.raises(ValueError):
        run_day(wh, feeds(spark, tx, ["transactions_30012024.txt"]), RUN2, opt)


def test_deleted_card_next_day(spark, scratch):
    wh = Warehouse(spark, scratch)
    cards = with_audit(fx.cards(spark, SF_SMALL).withColumnRenamed("account_num", "account"))
    run_day(wh, DayFeeds(cards=cards), RUN1)
    fewer = cards.where(F.col("card_num") != "C1 ")
    m = run_day(wh, DayFeeds(cards=fewer), RUN2)
    from ledgerwarden.schemas import CARDS_HIST
    h = wh.history(m, "cards", CARDS_HIST).where(F.col("card_num") == "C1 ").orderBy("effective_from").collect()
    assert [r.delete_flg for r in h] == ["N", "Y"]
    assert h[0].effective_to == RUN2 - dt.timedelta(seconds=1)


def test_retry_after_crash_before_publish(spark, scratch):
    """A run that wrote its folders but died before its manifest is invisible; the retry succeeds."""
    wh = Warehouse(spark, scratch)
    cards = with_audit(fx.cards(spark, SF_SMALL).withColumnRenamed("account_num", "account"))

    class Crash(Exception):
        pass

    real = wh.publish

    def crash(m):
        raise Crash()
    wh.publish = crash
    with pytest.raises(Crash):
        run_day(wh, DayFeeds(cards=cards), RUN1)
    wh.publish = real
    assert wh.latest().run_id == 0
    m = run_day(wh, DayFeeds(cards=cards), RUN1)
    from ledgerwarden.schemas import CARDS_HIST
    assert m.run_id == 1
    assert wh.history(m, "cards", CARDS_HIST).count() == cards.count()


def test_compact_closed_history(spark, scratch):
    from ledgerwarden.plans.state import compact
    from ledgerwarden.schemas import CARDS_HIST
    wh = Warehouse(spark, scratch)
    cards = with_audit(fx.cards(spark, SF_SMALL).withColumnRenamed("account_num", "account"))
    run_day(wh, DayFeeds(cards=cards), RUN1)
    run_day(wh, DayFeeds(cards=cards.where(F.col("card_num") != "C1 ")), RUN2)
    run_day(wh, DayFeeds(cards=cards.where(~F.col("card_num").isin("C1 ", "C2 "))), RUN2 + dt.timedelta(days=1))
    before = wh.latest()
    rows = sorted(tuple(r) for r in wh.history(before, "cards", CARDS_HIST).collect())
    assert len(before.tables["cards"]["closed"]) == 2
    after = compact(wh, "cards", CARDS_HIST)
    assert len(after.tables["cards"]["closed"]) == 1 and after.run_id == before.run_id + 1
    assert sorted(tuple(r) for r in wh.history(after, "cards", CARDS_HIST).collect()) == rows


def test_compact_fact_parts(spark, scratch):
    from ledgerwarden.plans.state import compact
    from ledgerwarden.schemas import TRANSACTIONS_FACT
    wh = Warehouse(spark, scratch)
    tx = fx.transactions(spark, SF_SMALL)
    run_day(wh, DayFeeds(transactions=tx.where(F.col("trans_date") < F.lit(CUT))), RUN1)
    m = run_day(wh, DayFeeds(transactions=tx.where(F.col("trans_date") >= F.lit(CUT))), RUN2)
    assert len(m.tables["transactions"]["parts"]) == 2
    after = compact(wh, "transactions", TRANSACTIONS_FACT)
    assert len(after.tables["transactions"]["parts"]) == 1
    assert wh.fact(after, "transactions", TRANSACTIONS_FACT).count() == tx.count()


def test_as_of_modes_in_a_daily_run(spark, scratch):
    """Single-version dimensions: as-of resolution gives the same report as all versions
    (terminals are loaded after the transactions they serve: the first version reaches back)."""
    from ledgerwarden.schemas import REPORT
    tx = fx.transactions(spark, SF_SMALL)
    out = {}
    for mode in ("all", "as_of"):
        wh = Warehouse(spark, f"{scratch}/{mode}")
        opt = RunOptions(guessing_within="3 days", owner_mode=mode, terminal_mode=mode)
        m = run_day(wh, feeds(spark, tx, ["transactions_30012024.txt"]), RUN2, opt)
        out[mode] = sorted(tuple(r) for r in wh.fact(m, "report", REPORT).collect())
    assert out["all"] == out["as_of"] and len(out["all"]) > 0


def test_unique_transactions_option(spark, scratch):
    """Q10: the same rows landed again under another file name add nothing when asked."""
    from ledgerwarden.schemas import TRANSACTIONS_FACT
    wh = Warehouse(spark, scratch)
    tx = fx.transactions(spark, SF_SMALL)
    opt = RunOptions(unique_transactions=True)
    run_day(wh, DayFeeds(transactions=tx, files=["transactions_15012024.txt"]), RUN1, opt)
    m = run_day(wh, DayFeeds(transactions=tx, files=["transactions_15012024_copy.txt"]), RUN2, opt)
    assert wh.fact(m, "transactions", TRANSACTIONS_FACT).count() == tx.count()
