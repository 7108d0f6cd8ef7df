"""

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose work
grows with the tables (the daily runs write a warehouse first). Open SCD2 ends (``9999-12-31``) are shown as NULL so
results convert to pandas; the library itself keeps the far-future value.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwarden.functions.columns import date_lit, is_open, ntz_lit
from ledgerwarden.operators import scd2
from ledgerwarden.operators.facts import append_new
from ledgerwarden.operators.keys import keys_absent
from ledgerwarden.operators.owner import owner_bridge
from ledgerwarden.operators.report import fraud_report
from ledgerwarden.operators.rules import rule_account, rule_cities, rule_guessing, rule_passport
from ledgerwarden.plans.daily import DayFeeds, RunOptions, run_day
from ledgerwarden.plans.state import Warehouse
from ledgerwarden.session import scratch_path
from ledgerwarden.sources import fixtures as fx
from ledgerwarden.sources.extract import extract_increment, live_keys, watermark_advance
from ledgerwarden.sources.feeds import (
    amount_audit,
    clean_transactions,
    format_transaction_lines,
    parse_transaction_lines,
    pick_feed,
    read_blacklist,
    read_terminals,
)
from ledgerwarden.schemas import CARDS_HIST, REPORT, SEED_REPORT_DATE, TRANSACTIONS_FACT

# Parameters of the catalog (shared with the oracle SQL).
REPORT_DT = SEED_REPORT_DATE
T0 = dt.datetime(2024, 1, 1)                     # first load of a history
RUN_TS = dt.datetime(2024, 1, 2, 2, 38)          # snapshot merge run
CDC_CHANGE_TS = dt.datetime(2024, 1, 2, 10, 0)   # change time of the CDC batch
CDC_RUN_TS = dt.datetime(2024, 1, 3, 2, 38)      # CDC run
EXTRACT_WATERMARK = dt.datetime(2000, 1, 1)
BLACKLIST_KNOWN_BEFORE = dt.date(2024, 1, 11)
REPORT_CUT = dt.datetime(2024, 1, 16)
AS_OF_LAG_DAYS = 90
PHONE_CHANGE = dt.datetime(2024, 1, 15)          # a quarter of the clients change phone
TERMINALS_LOADED = dt.datetime(2024, 1, 15)      # terminals first loaded mid-month
DENSE = 216                                      # 3 days become 20 minutes
LOG_OPENED = dt.datetime(1990, 1, 1)             # open versions before the change feed
LOG_RUN_TS = dt.datetime(2024, 1, 3, 2, 38)
DAY1_RUN_TS = dt.datetime(2024, 1, 16, 2, 38)    # the two daily runs and the changes between them
DAY2_CHANGE_TS = dt.datetime(2024, 1, 16, 10, 0)
DAY2_RUN_TS = dt.datetime(2024, 1, 31, 2, 38)
FEED_WORDS = ["transactions", "terminals", "blacklist"]

Query = Callable[[SparkSession, str], DataFrame]


def shown(hist: DataFrame) -> DataFrame:
    """History with open ends as NULL."""
    return hist.withColumn("effective_to", F.when(is_open(), F.lit(None)).otherwise(F.col("effective_to")))


@fx.memoised
def _bridge(spark, d, mode="all") -> DataFrame:
    """The owner bridge over the fixtures (a lazy view, analysed once per session)."""
    return owner_bridge(fx.cards(spark, d), fx.accounts(spark, d), fx.clients(spark, d),
                        fx.blacklist(spark, d), mode=mode)


def _visible(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


# ----------------------------------------------------------------------------- rules and report

def q_owner_bridge(spark, d):
    return _bridge(spark, d).select("*")   # a fresh Dataset each call


def q_rule_passport(spark, d):
    return _visible(rule_passport(fx.transactions(spark, d), _bridge(spark, d), REPORT_DT))


def q_rule_account(spark, d):
    return _visible(rule_account(fx.transactions(spark, d), _bridge(spark, d), REPORT_DT))


def q_rule_cities(spark, d):
    return _visible(rule_cities(fx.transactions(spark, d), fx.terminals(spark, d), _bridge(spark, d),
                                "1 hour", REPORT_DT))


def _guessing(within):
    def q(spark, d):
        return _visible(rule_guessing(fx.transactions(spark, d), _bridge(spark, d), within, 3, REPORT_DT))
    return q


def q_fraud_report(spark, d):
    return fraud_report(fx.transactions(spark, d), fx.terminals(spark, d), _bridge(spark, d),
                        report_dt=REPORT_DT, guessing_within="3 days")


def q_report_next_day(spark, d):
    tx = fx.transactions(spark, d)
    term, br = fx.terminals(spark, d), _bridge(spark, d)
    cut = ntz_lit(REPORT_CUT)
    prior = fraud_report(tx.where(F.col("trans_date") < cut), term, br, report_dt=REPORT_DT,
                         guessing_within="3 days")
    return fraud_report(tx, term, br, prior=prior, report_dt=REPORT_DT + dt.timedelta(days=1),
                        guessing_within="3 days")


def _client_history(spark, d):
    """Clients with two versions where ``c_custkey % 4 = 0``: the phone changes."""
    cl = fx.clients(spark, d)
    tracked = [c for c in cl.columns if c != "client_id"]
    changes = (cl.where(F.col("client_id").cast("long") % 4 == 0)
                 .withColumn("phone", F.concat(F.lit("+8"), F.col("client_id")))
                 .withColumn("mod_dt", ntz_lit(PHONE_CHANGE)))
    hist = scd2.initial_history(cl, ["client_id"], tracked, T0)
    return scd2.scd2_merge(hist, changes, ["client_id"], tracked, "mod_dt")


def q_fraud_report_as_of(spark, d):
    cards = scd2.initial_history(fx.cards(spark, d), ["card_num"], ["account_num"], T0)
    accounts = scd2.initial_history(fx.accounts(spark, d), ["account_num"], ["valid_to", "client"], T0)
    terms = scd2.initial_history(fx.terminals(spark, d), ["terminal_id"],
                                 ["terminal_type", "terminal_city", "terminal_address"], TERMINALS_LOADED)
    owners = owner_bridge(cards, accounts, _client_history(spark, d), fx.blacklist(spark, d), mode="as_of")
    return fraud_report(fx.transactions(spark, d), terms, owners, report_dt=REPORT_DT,
                        guessing_within="3 days", terminal_mode="as_of")


# ----------------------------------------------------------------------------- SCD2

def _prev_hist(spark, d):
    return scd2.initial_history(fx.snapshot_prev(spark, d), ["k"], ["a", "b"], T0)


def _classified(action):
    def q(spark, d):
        g = scd2.cogroup_snapshot(_prev_hist(spark, d), fx.snapshot_cur(spark, d), ["k"], ["a", "b"])
        if action:
            g = g.where(F.col("action") == action)
        return g.select("k", "action", F.col("o.a").alias("old_a"), F.col("o.b").alias("old_b"),
                        F.col("s.a").alias("new_a"), F.col("s.b").alias("new_b"))
    return q


def q_scd2_merge_snapshot(spark, d):
    h = scd2.scd2_merge_snapshot(_prev_hist(spark, d), fx.snapshot_cur(spark, d), ["k"], ["a", "b"], RUN_TS)
    return shown(h)


def _customers(spark, d):
    return fx.table(spark, d, "customer")


def q_scd2_merge_cdc(spark, d):
    c = _customers(spark, d)
    k = F.col("c_custkey")
    hist = scd2.initial_history(c.where(k % 13 != 0), ["c_custkey"], ["c_nationkey"], T0)
    changes = c.where((k % 3 == 0) & (k % 17 != 0)).select(
        "c_custkey", (F.col("c_nationkey") + k % 2).alias("c_nationkey"),
        ntz_lit(CDC_CHANGE_TS).alias("mod_dt"))
    live = c.where(k % 17 != 0).select("c_custkey")
    h = scd2.scd2_merge(hist, changes, ["c_custkey"], ["c_nationkey"], "mod_dt", live, CDC_RUN_TS)
    return shown(h)


def _log_hist(spark, d):
    o = fx.table(spark, d, "orders")
    return scd2.scd2_from_log(o, ["o_custkey"], ["o_orderpriority"], "o_orderdate", ["o_orderkey"])


def q_scd2_from_log(spark, d):
    return shown(_log_hist(spark, d))


def q_scd2_current(spark, d):
    h = _log_hist(spark, d)
    return h.where(is_open() & (F.col("delete_flg") == "N")).select("o_custkey", "o_orderpriority",
                                                                    "effective_from")


def q_scd2_as_of(spark, d):
    o = fx.table(spark, d, "orders")
    ev = o.select("o_orderkey", "o_custkey",
                  (F.col("o_orderdate") - F.expr(f"INTERVAL '{AS_OF_LAG_DAYS}' DAY")).alias("as_of"))
    got = scd2.scd2_as_of(ev, _log_hist(spark, d), ["o_custkey"], "as_of", ["o_orderpriority"])
    return got.select("o_orderkey", "o_custkey", "as_of", "o_orderpriority", "effective_from")


def q_scd2_from_snapshots(spark, d):
    o = fx.table(spark, d, "orders")
    snaps = (o.groupBy(F.date_trunc("year", "o_orderdate").alias("snap_ts"), "o_custkey")
              .agg(F.max("o_orderpriority").alias("o_orderpriority")))
    h = scd2.scd2_from_snapshots(snaps, ["o_custkey"], ["o_orderpriority"], "snap_ts")
    return shown(h)


def q_not_in_null_aware(spark, d):
    c = _customers(spark, d)
    right = c.select(F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey")).alias("k"))
    return keys_absent(c.select("c_custkey"), right, "c_custkey", "k", null_aware=True)


def q_not_in_plain(spark, d):
    c = _customers(spark, d)
    right = c.where(F.col("c_custkey") % 2 == 0).select(F.col("c_custkey").alias("k"))
    return keys_absent(c.select("c_custkey"), right, "c_custkey", "k", null_aware=True)


def q_anti_keys(spark, d):
    c = _customers(spark, d)
    right = c.select(F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey")).alias("k"))
    return keys_absent(c.select("c_custkey"), right, "c_custkey", "k", null_aware=False)


# ----------------------------------------------------------------------------- sources and facts

def _extract(spark, d):
    return extract_increment(fx.feed(spark, d), EXTRACT_WATERMARK, ["o_orderkey", "o_custkey"])


def q_extract_increment(spark, d):
    return _extract(spark, d)


def q_watermark_advance(spark, d):
    return watermark_advance(_extract(spark, d), EXTRACT_WATERMARK)


def q_live_keys(spark, d):
    return live_keys(fx.feed(spark, d), ["o_orderkey"])


def q_transactions_clean(spark, d):
    lines = format_transaction_lines(fx.transactions(spark, d, True))
    return clean_transactions(parse_transaction_lines(lines))


def q_feed_pick(spark, d):
    e = fx.table(spark, d, "events")
    kinds = F.explode(F.array(*[F.struct(F.lit(w).alias("w"), F.lit(x).alias("x")) for w, x in
                                (("transactions", ".txt"), ("terminals", ".xlsx"),
                                 ("passport_blacklist", ".xlsx"))])).alias("kind")
    days = e.select(F.to_date("ts").alias("day")).distinct()
    files = days.select("day", kinds).select(
        F.concat(F.col("kind.w"), F.lit("_"), F.date_format("day", "ddMMyyyy"),
                 F.col("kind.x")).alias("file_name"))
    return pick_feed(files, FEED_WORDS)


def q_blacklist_append(spark, d):
    bl = fx.blacklist(spark, d)
    fact = bl.where(F.col("entry_dt") < date_lit(BLACKLIST_KNOWN_BEFORE))
    return append_new(fact, bl, "passport_num", "entry_dt")


# ----------------------------------------------------------------------------- exact amounts, dense times, NULL keys

def _long_amounts(spark, d):
    """The feed with five digits behind the comma, some unreadable, too large or too fine amounts."""
    e = fx.table(spark, d, "events")
    digits = F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0")
    amount = (F.when(F.col("event_id") % 97 == 0, F.lit("n/a"))
               .when(F.col("event_id") % 89 == 0, F.concat(F.lit("1"), F.repeat(F.lit("0"), F.lit(30)), F.lit(",5")))
               .when(F.col("event_id") % 83 == 0, F.lit(None))
               .when(F.col("event_id") % 79 == 0, F.concat(F.lit("7,00000000005"), digits, F.lit("1")))
               .otherwise(F.concat((F.col("event_id") * 1000003).cast("string"), F.lit(",00"), digits)))
    return e.select(F.col("event_id").cast("string").alias("transaction_id"),
                    F.col("ts").cast("string").alias("transaction_date"), amount.alias("amount"),
                    F.lit("C1").alias("card_num"), F.lit("PAYMENT").alias("oper_type"),
                    F.lit("SUCCESS").alias("oper_result"), F.lit("T1").alias("terminal"))


def q_amounts_exact(spark, d):
    return clean_transactions(_long_amounts(spark, d)).select("trans_id", F.col("amt").cast("string").alias("amt"))


def q_amounts_audit(spark, d):
    return amount_audit(_long_amounts(spark, d))


def q_rule_guessing_dense(spark, d):
    """Rule 4 at its default 20 minutes over transactions whose times are drawn together."""
    tx = fx.transactions(spark, d)
    us = f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{T0}', trans_date) div {DENSE}"
    tx = tx.withColumn("trans_date", F.expr(f"timestampadd(MICROSECOND, {us}, TIMESTAMP_NTZ'{T0}')"))
    return _visible(rule_guessing(tx, _bridge(spark, d), report_dt=REPORT_DT))


def q_not_in_left_nulls(spark, d):
    c = _customers(spark, d)
    left = c.select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey")).alias("k"))
    right = c.where(F.col("c_custkey") % 2 == 0).select(F.col("c_custkey").alias("r"))
    return keys_absent(left, right, "k", "r", null_aware=True)


# ----------------------------------------------------------------------------- change feed with several changes a key

def q_scd2_merge_log(spark, d):
    """Orders as a change feed over customers: every change of the batch becomes a version."""
    c, o = _customers(spark, d), fx.table(spark, d, "orders")
    opened = c.where(F.col("c_custkey") % 13 != 0).select(
        F.col("c_custkey").alias("o_custkey"), F.lit("3-MEDIUM").alias("o_orderpriority"))
    hist = scd2.initial_history(opened, ["o_custkey"], ["o_orderpriority"], LOG_OPENED)
    live = c.where(F.col("c_custkey") % 17 != 0).select(F.col("c_custkey").alias("o_custkey"))
    return shown(scd2.scd2_merge_log(hist, o.select("o_custkey", "o_orderpriority", "o_orderdate"), ["o_custkey"],
                                     ["o_orderpriority"], "o_orderdate", live, LOG_RUN_TS))


# ----------------------------------------------------------------------------- two daily runs

def _two_days(spark, d, late: bool = False, **options):
    """O12 twice into a fresh folder: a first load, then a day with changes, deletes and late owners.

    ``late``: every 11th transaction of the first days comes on the second.
    """
    def audited(df, changed):
        return df.withColumn("create_dt", ntz_lit(T0)).withColumn(
            "update_dt", F.when(changed, ntz_lit(DAY2_CHANGE_TS)))

    none = F.lit(False)
    key = F.col("card_num").substr(2, 20).cast("long")
    moves, gone = key % 5 == 0, key % 17 == 0
    cards = fx.cards(spark, d).withColumnRenamed("account_num", "account")
    cards2 = cards.where(~gone).withColumn(
        "account", F.when(moves, F.concat(F.lit("A"), (key + 1).cast("string"))).otherwise(F.col("account")))
    accounts = audited(fx.accounts(spark, d).withColumnRenamed("account_num", "account"), none)
    clients, client = fx.clients(spark, d), F.col("client_id").cast("long")
    clients2 = clients.withColumn("phone", F.when(client % 4 == 0, F.concat(F.lit("+8"), "client_id"))
                                  .otherwise(F.col("phone")))
    terminals = fx.terminals(spark, d)
    terminals2 = terminals.withColumn("terminal_city", F.when(
        F.col("terminal_id").substr(2, 20).cast("long") % 3 == 0, F.lit("Elsewhere")).otherwise(F.col("terminal_city")))
    bl, tx = fx.blacklist(spark, d), fx.transactions(spark, d)
    first = F.col("trans_date") < ntz_lit(REPORT_CUT)
    if late:
        first = first & (F.col("trans_id").cast("long") % 11 != 0)
    opt = RunOptions(guessing_within="3 days", owner_mode="current", terminal_mode="current", **options)
    wh = Warehouse(spark, scratch_path(spark, "daily-run", uuid.uuid4().hex))
    run_day(wh, DayFeeds(audited(cards, none), accounts, audited(clients, none), terminals,
                         bl.where(F.col("entry_dt") < date_lit(BLACKLIST_KNOWN_BEFORE)), tx.where(first)),
            DAY1_RUN_TS, opt)
    m = run_day(wh, DayFeeds(audited(cards2, moves), accounts, audited(clients2, client % 4 == 0), terminals2,
                             bl, tx.where(~first)), DAY2_RUN_TS, opt)
    return wh, m


def q_daily_run(spark, d):
    wh, m = _two_days(spark, d)
    return wh.fact(m, "report", REPORT)


def q_report_incremental(spark, d):
    """The same two days with late transactions, the second day's report from what the day can change."""
    wh, m = _two_days(spark, d, late=True, incremental=True, null_safe_report=True)
    return wh.fact(m, "report", REPORT)


def q_daily_run_cards(spark, d):
    wh, m = _two_days(spark, d)
    return shown(wh.history(m, "cards", CARDS_HIST))


def q_daily_run_changes(spark, d):
    """A run whose card source is a change log: every change of the batch becomes a version."""
    log = fx.table(spark, d, "orders").where(F.col("o_custkey") % 3 != 0).select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("card_num"),
        F.concat(F.lit("A"), F.substring("o_orderpriority", 1, 1)).alias("account"),
        ntz_lit(T0).alias("create_dt"), F.col("o_orderdate").alias("update_dt"))
    wh = Warehouse(spark, scratch_path(spark, "daily-run", uuid.uuid4().hex))
    cards = log.withColumn("update_dt", F.lit(None).cast("timestamp_ntz")).withColumn("account", F.lit("A0")) \
        .withColumn("create_dt", ntz_lit(LOG_OPENED)).distinct()
    run_day(wh, DayFeeds(cards=cards), DAY1_RUN_TS, RunOptions(every_change=True))
    stay = log.where(F.substring("card_num", 2, 20).cast("long") % 17 != 0)
    m = run_day(wh, DayFeeds(cards=stay), DAY2_RUN_TS, RunOptions(every_change=True))
    return shown(wh.history(m, "cards", CARDS_HIST))


# ----------------------------------------------------------------------------- refused rows, unique appends, sheets

def _rough_feed(spark, d):
    """The feed of ``_long_amounts`` with some ids and times missing or unreadable."""
    n = F.col("transaction_id").cast("long")
    return (_long_amounts(spark, d)
            .withColumn("transaction_date", F.when(n % 73 == 0, F.lit("31.02.2024")).when(n % 71 == 0, F.lit(" "))
                        .otherwise(F.col("transaction_date")))
            .withColumn("transaction_id", F.when(n % 67 == 0, F.lit(None)).otherwise(F.col("transaction_id"))))


def q_quarantine_rows(spark, d):
    """What a run refuses of a rough feed, a source with NULL keys and a blacklist without passports, as it came."""
    cards = fx.cards(spark, d).select(
        F.when(F.substring("card_num", 2, 20).cast("long") % 19 != 0, F.col("card_num")).alias("card_num"),
        F.col("account_num").alias("account"), ntz_lit(T0).alias("create_dt"),
        F.lit(None).cast("timestamp_ntz").alias("update_dt"))
    bl = fx.blacklist(spark, d).withColumn("passport_num", F.when(F.dayofmonth("entry_dt") % 4 != 0, F.col("passport_num")))
    wh = Warehouse(spark, scratch_path(spark, "quarantine", uuid.uuid4().hex))
    m = run_day(wh, DayFeeds(cards=cards, blacklist=bl, transactions_raw=_rough_feed(spark, d)), DAY1_RUN_TS)
    told = wh.rejected(m)

    def of(field):
        return F.get_json_object("row", f"$.{field}").alias(field)
    return told.select("source", "reason", of("transaction_id"), of("transaction_date"), of("amount"), of("account"), of("entry_dt"))


def q_append_unique(spark, d):
    """Two runs with unique transactions, the second with a reload of old rows and with twins."""
    tx = fx.transactions(spark, d)
    old = F.col("trans_date") < ntz_lit(REPORT_CUT)
    again = tx.where(old & (F.col("trans_id").cast("long") % 3 == 0))
    twins = tx.where(~old & (F.col("trans_id").cast("long") % 5 == 0))
    opt = RunOptions(unique_transactions=True)
    wh = Warehouse(spark, scratch_path(spark, "unique", uuid.uuid4().hex))
    run_day(wh, DayFeeds(transactions=tx.where(old)), DAY1_RUN_TS, opt)
    m = run_day(wh, DayFeeds(transactions=tx.where(~old).unionAll(again).unionAll(twins)), DAY2_RUN_TS, opt)
    return wh.fact(m, "transactions", TRANSACTIONS_FACT)


def _sheet(df, *columns):
    """A sheet with a header row, landed as text; the columns count by position."""
    path = scratch_path(df.sparkSession, "sheets", uuid.uuid4().hex)
    df.select(*columns).write.option("header", True).csv(path)
    return path


def q_terminals_sheet(spark, d):
    columns = ["terminal_id", "terminal_type", "terminal_city", "terminal_address"]
    return read_terminals(spark, _sheet(fx.terminals(spark, d).toDF(*"wxyz"), *"wxyz")).select(*columns)


def q_blacklist_sheet(spark, d):
    return read_blacklist(spark, _sheet(fx.blacklist(spark, d), F.col("entry_dt").alias("date"), F.col("passport_num").alias("passport")))


def q_transactions_pattern(spark, d):
    """Times written day first, read with a pattern."""
    raw = parse_transaction_lines(format_transaction_lines(fx.transactions(spark, d))).withColumn(
        "transaction_date", F.regexp_replace("transaction_date", r"(\d+)-(\d+)-(\d+) (\d+:\d+:\d+).*", "$3.$2.$1 $4"))
    return clean_transactions(raw, ts_format="dd.MM.yyyy HH:mm:ss")


def q_report_distinct(spark, d):
    """The report without equal rows of one run, over transactions that come twice."""
    tx = fx.transactions(spark, d)
    return fraud_report(tx.unionAll(tx), fx.terminals(spark, d), _bridge(spark, d), report_dt=REPORT_DT,
                        guessing_within="3 days", distinct=True)


def q_scd2_reopen(spark, d):
    """A key that was deleted and comes back opens again: the previous snapshot after the current one."""
    args = (["k"], ["a", "b"])
    gone = scd2.scd2_merge_snapshot(_prev_hist(spark, d), fx.snapshot_cur(spark, d), *args, RUN_TS)
    return shown(scd2.scd2_merge_snapshot(gone, fx.snapshot_prev(spark, d), *args, DAY2_RUN_TS, reopen=True))


QUERIES: dict[str, Query] = {
    "fraud_report": q_fraud_report,
    "report_next_day": q_report_next_day,
    "fraud_report_as_of": q_fraud_report_as_of,
    "rule_passport": q_rule_passport,
    "rule_account": q_rule_account,
    "rule_cities": q_rule_cities,
    "rule_guessing": _guessing("20 minutes"),
    "rule_guessing_1d": _guessing("1 day"),
    "rule_guessing_3d": _guessing("3 days"),
    "owner_bridge": q_owner_bridge,
    "scd2_classify": _classified(None),
    "scd2_new": _classified("new"),
    "scd2_changed": _classified("changed"),
    "scd2_deleted": _classified("deleted"),
    "scd2_merge_snapshot": q_scd2_merge_snapshot,
    "scd2_merge_cdc": q_scd2_merge_cdc,
    "scd2_from_log": q_scd2_from_log,
    "scd2_current": q_scd2_current,
    "scd2_as_of": q_scd2_as_of,
    "scd2_from_snapshots": q_scd2_from_snapshots,
    "not_in_null_aware": q_not_in_null_aware,
    "not_in_plain": q_not_in_plain,
    "anti_keys": q_anti_keys,
    "extract_increment": q_extract_increment,
    "watermark_advance": q_watermark_advance,
    "live_keys": q_live_keys,
    "transactions_clean": q_transactions_clean,
    "feed_pick": q_feed_pick,
    "blacklist_append": q_blacklist_append,
    "amounts_exact": q_amounts_exact,
    "amounts_audit": q_amounts_audit,
    "rule_guessing_dense": q_rule_guessing_dense,
    "not_in_left_nulls": q_not_in_left_nulls,
    "scd2_merge_log": q_scd2_merge_log,
    "daily_run": q_daily_run,
    "report_incremental": q_report_incremental,
    "daily_run_cards": q_daily_run_cards,
    "daily_run_changes": q_daily_run_changes,
    "quarantine_rows": q_quarantine_rows,
    "append_unique": q_append_unique,
    "terminals_sheet": q_terminals_sheet,
    "blacklist_sheet": q_blacklist_sheet,
    "transactions_pattern": q_transactions_pattern,
    "report_distinct": q_report_distinct,
    "scd2_reopen": q_scd2_reopen,
}
