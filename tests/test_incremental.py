"""The incremental report equals the full rescan, run after run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerwarden.plans.daily import DayFeeds, RunOptions, run_day
from ledgerwarden.plans.incremental import day_ranges, in_days, reach_days, report_scope
from ledgerwarden.plans.state import DAY, Warehouse
from ledgerwarden.schemas import REPORT, TRANSACTIONS_FACT
from ledgerwarden.sources import fixtures as fx
from conftest import SF_SMALL
from test_daily import with_audit

D = dt.date


def test_day_ranges_close_gaps_that_a_span_can_cross():
    assert day_ranges([], 1) == []
    assert day_ranges([D(2024, 1, 5), D(2024, 1, 5)], 1) == [(D(2024, 1, 4), D(2024, 1, 6))]
    # the 4th..6th and 8th..10th: one day apart, within reach of each other over the 7th
    assert day_ranges([D(2024, 1, 9), D(2024, 1, 5)], 1) == [(D(2024, 1, 4), D(2024, 1, 10))]
    far = day_ranges([D(2024, 1, 5), D(2024, 1, 12)], 2)
    assert far == [(D(2024, 1, 3), D(2024, 1, 14))]     # the 8th and 9th lie between the 7th and the 10th: two days
    assert len(day_ranges([D(2024, 1, 5), D(2024, 1, 20)], 2)) == 2
    for days, reach in (([1, 4, 9, 13, 20, 28], r) for r in (1, 2, 3, 4)):
        out = day_ranges([D(2024, 1, x) for x in days], reach)
        assert all((b[0] - a[1]).days > reach for a, b in zip(out, out[1:]))
    assert day_ranges([dt.date.min, dt.date.max], 3)[0][0] == dt.date.min


def test_reach():
    assert reach_days("1 hour", "20 minutes") == 1
    assert reach_days("1 hour", "3 days") == 3
    assert reach_days("36 hours") == 2


def days_of_feeds(spark):
    """First load; later days; late transactions only; a late blacklist entry only; owners and terminals moved."""
    tx = fx.transactions(spark, SF_SMALL)
    no = F.col("trans_id").cast("long")
    cut, late = dt.datetime(2024, 1, 16), no % 7 == 3
    cards = with_audit(fx.cards(spark, SF_SMALL).withColumnRenamed("account_num", "account"))
    accounts = with_audit(fx.accounts(spark, SF_SMALL).withColumnRenamed("account_num", "account"))
    clients = with_audit(fx.clients(spark, SF_SMALL))
    terminals, bl = fx.terminals(spark, SF_SMALL), fx.blacklist(spark, SF_SMALL)
    more = bl.unionAll(spark.createDataFrame([("P12", D(2024, 1, 3))], bl.schema))
    moved = cards.withColumn("account", F.when(F.col("card_num") == "C3 ", F.lit("A4")).otherwise(F.col("account"))) \
        .withColumn("update_dt", F.when(F.col("card_num") == "C3 ", F.lit(dt.datetime(2024, 1, 5)).cast("timestamp_ntz")))
    town = terminals.withColumn("terminal_city", F.when(F.col("terminal_id") == "T2", F.lit("Elsewhere"))
                                .otherwise(F.col("terminal_city")))
    return [DayFeeds(cards, accounts, clients, terminals, bl, tx.where((F.col("trans_date") < cut) & ~late)),
            DayFeeds(cards, accounts, clients, terminals, bl, tx.where((F.col("trans_date") >= cut) & ~late)),
            DayFeeds(transactions=tx.where(late & (F.dayofmonth("trans_date") % 3 == 1))),
            DayFeeds(blacklist=more),
            DayFeeds(cards=moved, accounts=accounts, clients=clients),
            DayFeeds(terminals=town.where("terminal_id <> 'T5'"))]


@pytest.mark.parametrize("mode", ["current", "as_of"])
def test_equals_the_full_rescan_every_day(spark, scratch, mode):
    got = {}
    for incremental in (False, True):
        wh = Warehouse(spark, f"{scratch}/{mode}-{incremental}")
        opt = RunOptions(guessing_within="3 days", owner_mode=mode, terminal_mode=mode, null_safe_report=True,
                         incremental=incremental)
        days = []
        for i, feeds in enumerate(days_of_feeds(spark)):
            prev = wh.latest()
            m = run_day(wh, feeds, dt.datetime(2024, 2, 1 + i, 2, 38), opt)
            new = wh.added(prev, m, "report", REPORT)
            days.append(sorted((tuple(r) for r in new.collect()), key=str))
        got[incremental] = days
    assert got[True] == got[False]
    assert all(got[True][:5]), [len(rows) for rows in got[True]]


def test_reads_the_days_around_new_transactions_only(spark, scratch):
    wh = Warehouse(spark, scratch)
    tx = fx.transactions(spark, SF_SMALL)
    opt = RunOptions(null_safe_report=True, incremental=True)
    day = F.to_date("trans_date")
    run_day(wh, DayFeeds(transactions=tx.where(day != D(2024, 1, 10))), dt.datetime(2024, 2, 1), opt)
    prev = wh.latest()
    m = run_day(wh, DayFeeds(transactions=tx.where(day == D(2024, 1, 10))), dt.datetime(2024, 2, 2), opt)
    scope, days = report_scope(wh, prev, m, [opt.cities_within, opt.guessing_within])
    assert days == [(D(2024, 1, 9), D(2024, 1, 11))]
    plan = scope._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({DAY}" in plan
    near = tx.where(day.between(D(2024, 1, 9), D(2024, 1, 11)))
    assert scope.count() == near.count() > 0
    assert wh.fact(m, "transactions", TRANSACTIONS_FACT).count() == tx.count()
    assert wh.fact(m, "transactions", TRANSACTIONS_FACT, where=in_days(DAY, [])).count() == 0


def test_rows_without_a_time_are_kept_and_report_nothing(spark, scratch):
    wh = Warehouse(spark, scratch)
    odd = spark.createDataFrame([("1", None, "C1", "PAYMENT", None, "SUCCESS", "T1"),
                                 ("2", None, None, None, None, None, None)], TRANSACTIONS_FACT)
    opt = RunOptions(null_safe_report=True, incremental=True)
    run_day(wh, DayFeeds(transactions=odd.limit(0)), dt.datetime(2024, 2, 1), opt)
    m = run_day(wh, DayFeeds(transactions=odd), dt.datetime(2024, 2, 2), opt)
    assert wh.fact(m, "transactions", TRANSACTIONS_FACT).count() == 2
    assert wh.fact(m, "report", REPORT).count() == 0


def test_other_options_scan_all_again(spark, scratch):
    wh = Warehouse(spark, scratch)
    base = dict(null_safe_report=True, incremental=True)
    run_day(wh, DayFeeds(), dt.datetime(2024, 2, 1), RunOptions(**base))
    before = wh.latest()
    assert before.report_basis == RunOptions(**base).basis()
    m = run_day(wh, DayFeeds(), dt.datetime(2024, 2, 2), RunOptions(guessing_within="1 day", **base))
    assert m.report_basis != before.report_basis
    with pytest.raises(ValueError):
        run_day(wh, DayFeeds(), dt.datetime(2024, 2, 3), RunOptions(incremental=True))
