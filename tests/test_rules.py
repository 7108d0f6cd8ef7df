"""Hand-made cases for the four rules and the report (FIXTURES.md section 4)."""

import datetime as dt
from decimal import Decimal

from ledgerwarden.operators.owner import owner_bridge
from ledgerwarden.operators.report import accumulate, fraud_report
from ledgerwarden.operators.rules import rule_account, rule_cities, rule_guessing, rule_passport
from ledgerwarden.schemas import (
    ACCOUNTS_HIST,
    BLACKLIST_FACT,
    CARDS_HIST,
    CLIENTS_HIST,
    REPORT,
    TERMINALS_HIST,
    TRANSACTIONS_FACT,
)

T = dt.datetime
D = dt.date
FF = dt.datetime(9999, 12, 31)
T0 = dt.datetime(2024, 1, 1)


def hist(spark, schema, rows):
    return spark.createDataFrame([r + (T0, FF, "N") for r in rows], schema)


def owners(spark, valid_to=D(2024, 3, 1), passport_valid_to=D(2024, 3, 1), patronymic="P",
           passport="P1", blacklist=()):
    cards = hist(spark, CARDS_HIST, [("C1 ", "A1")])
    accounts = hist(spark, ACCOUNTS_HIST, [("A1", valid_to, "K1")])
    clients = hist(spark, CLIENTS_HIST, [("K1", "Last", "First", patronymic, None, passport,
                                          passport_valid_to, "+7")])
    bl = spark.createDataFrame(list(blacklist), BLACKLIST_FACT)
    return owner_bridge(cards, accounts, clients, bl)


def tx(spark, rows):
    """rows: (id, time, oper_type, amount, result, terminal); card C1."""
    return spark.createDataFrame(
        [(i, t, "C1", op, Decimal(a), res, term) for i, t, op, a, res, term in rows], TRANSACTIONS_FACT)


def terminals(spark, rows):
    return spark.createDataFrame([(tid, "POS", city, "addr", T0, FF, "N") for tid, city in rows],
                                 TERMINALS_HIST)


def events(df):
    return sorted((r.event_dt, r.event_type) for r in df.collect())


def test_passport_expiry_day_midnight_flagged(spark):
    b = owners(spark, passport_valid_to=D(2024, 1, 10))
    t = tx(spark, [("1", T(2024, 1, 10, 0, 0, 0), "PAYMENT", "1", "SUCCESS", "T1"),
                   ("2", T(2024, 1, 9, 23, 59, 59), "PAYMENT", "1", "SUCCESS", "T1")])
    assert events(rule_passport(t, b)) == [(T(2024, 1, 10), "1")]


def test_account_end_day_midnight_not_flagged(spark):
    b = owners(spark, valid_to=D(2024, 1, 10))
    t = tx(spark, [("1", T(2024, 1, 10, 0, 0, 0), "PAYMENT", "1", "SUCCESS", "T1"),
                   ("2", T(2024, 1, 10, 0, 0, 1), "PAYMENT", "1", "SUCCESS", "T1")])
    assert events(rule_account(t, b)) == [(T(2024, 1, 10, 0, 0, 1), "2")]


def test_blacklist_without_expiry(spark):
    b = owners(spark, passport_valid_to=None, blacklist=[("P1", D(2024, 1, 5)), ("P1", D(2024, 1, 2))])
    t = tx(spark, [("1", T(2024, 1, 1, 12), "PAYMENT", "1", "SUCCESS", "T1"),
                   ("2", T(2024, 1, 2, 0), "PAYMENT", "1", "SUCCESS", "T1")])
    assert events(rule_passport(t, b)) == [(T(2024, 1, 2), "1")]


def test_null_patronymic_gives_null_fio(spark):
    b = owners(spark, patronymic=None, valid_to=D(2024, 1, 1))
    t = tx(spark, [("1", T(2024, 1, 5), "PAYMENT", "1", "SUCCESS", "T1")])
    assert [r.fio for r in rule_account(t, b).collect()] == [None]


def test_padded_card_matches(spark):
    b = owners(spark, valid_to=D(2024, 1, 1))
    t = spark.createDataFrame([("1", T(2024, 1, 5), "C1   ", "PAYMENT", Decimal(1), "SUCCESS", "T1")],
                              TRANSACTIONS_FACT)
    assert rule_account(t, b).count() == 1


def test_cities_exactly_one_hour_and_one_second_more(spark):
    b = owners(spark)
    term = terminals(spark, [("T1", "A"), ("T2", "B"), ("T3", "C")])
    t = tx(spark, [("1", T(2024, 1, 1, 10), "PAYMENT", "1", "SUCCESS", "T1"),
                   ("2", T(2024, 1, 1, 11), "PAYMENT", "1", "SUCCESS", "T2"),
                   ("3", T(2024, 1, 1, 12, 0, 1), "PAYMENT", "1", "SUCCESS", "T3")])
    assert events(rule_cities(t, term, b)) == [(T(2024, 1, 1, 11), "3")]


def test_cities_adjacent_pairs_only_and_unknown_terminal_skipped(spark):
    b = owners(spark)
    term = terminals(spark, [("T1", "A"), ("T2", "B")])
    t = tx(spark, [("1", T(2024, 1, 1, 10, 0), "PAYMENT", "1", "SUCCESS", "T1"),
                   ("2", T(2024, 1, 1, 10, 10), "PAYMENT", "1", "SUCCESS", "T1"),
                   ("3", T(2024, 1, 1, 10, 20), "PAYMENT", "1", "SUCCESS", "T9"),
                   ("4", T(2024, 1, 1, 10, 30), "PAYMENT", "1", "SUCCESS", "T2")])
    assert events(rule_cities(t, term, b)) == [(T(2024, 1, 1, 10, 30), "3")]


def test_terminal_with_two_versions(spark):
    b = owners(spark)
    term = spark.createDataFrame([("T1", "POS", "A", "x", T0, T(2024, 1, 1, 5), "N"),
                                  ("T1", "POS", "B", "x", T(2024, 1, 1, 5, 0, 1), FF, "N")], TERMINALS_HIST)
    t = tx(spark, [("1", T(2024, 1, 1, 10), "PAYMENT", "1", "SUCCESS", "T1")])
    assert rule_cities(t, term, b, terminal_mode="current").count() == 0
    assert rule_cities(t, term, b, terminal_mode="all").count() == 1   # the reference's false hit


def chain(spark, last_minutes=20, last_seconds=0, amounts=("30", "20", "10", "5"), extra=()):
    base = T(2024, 1, 1, 10)
    rows = [("1", base, "WITHDRAW", amounts[0], "REJECT", "T1"),
            ("2", base + dt.timedelta(minutes=5), "PAYMENT", amounts[1], "REJECT", "T1"),
            ("3", base + dt.timedelta(minutes=10), "WITHDRAW", amounts[2], "REJECT", "T1"),
            ("4", base + dt.timedelta(minutes=last_minutes, seconds=last_seconds), "PAYMENT",
             amounts[3], "SUCCESS", "T1")]
    return tx(spark, rows + list(extra))


def test_guessing_twenty_minutes_inclusive(spark):
    b = owners(spark)
    assert rule_guessing(chain(spark), b).count() == 1
    assert rule_guessing(chain(spark, 20, 1), b).count() == 0


def test_guessing_equal_amounts_and_two_rejects(spark):
    b = owners(spark)
    assert rule_guessing(chain(spark, amounts=("30", "20", "20", "5")), b).count() == 0
    two = tx(spark, [("1", T(2024, 1, 1, 10), "WITHDRAW", "30", "REJECT", "T1"),
                     ("2", T(2024, 1, 1, 10, 5), "WITHDRAW", "20", "REJECT", "T1"),
                     ("3", T(2024, 1, 1, 10, 6), "WITHDRAW", "10", "SUCCESS", "T1")])
    assert rule_guessing(two, b).count() == 0
    assert rule_guessing(two, b, rejects=2).count() == 1


def test_guessing_deposit_inside_chain_ignored(spark):
    b = owners(spark)
    dep = [("9", T(2024, 1, 1, 10, 7), "DEPOSIT", "1000", "SUCCESS", "T1")]
    assert rule_guessing(chain(spark, extra=dep), b).count() == 1


def test_report_lowest_rule_wins_and_prior_kept(spark):
    b = owners(spark, passport_valid_to=D(2024, 1, 1))
    term = terminals(spark, [("T1", "A"), ("T2", "B")])
    t = tx(spark, [("1", T(2024, 1, 5, 10), "PAYMENT", "1", "SUCCESS", "T1"),
                   ("2", T(2024, 1, 5, 10, 30), "PAYMENT", "1", "SUCCESS", "T2")])
    rep = fraud_report(t, term, b)
    assert events(rep) == [(T(2024, 1, 5, 10), "1"), (T(2024, 1, 5, 10, 30), "1")]
    prior = spark.createDataFrame([(T(2024, 1, 5, 10), "P1", "x", "y", "2", D(2021, 3, 1))], REPORT)
    assert events(fraud_report(t, term, b, prior=prior)) == [(T(2024, 1, 5, 10, 30), "1")]


def test_report_null_passport_parity_and_null_safe(spark):
    cand = spark.createDataFrame(
        [(T(2024, 1, 5), None, "f", "p", "1", D(2021, 3, 1), "1"),
         (T(2024, 1, 5), None, "f", "p", "2", D(2021, 3, 1), "1")],
        "event_dt timestamp_ntz, passport string, fio string, phone string, event_type string, "
        "report_dt date, _trans_id string")
    prior = spark.createDataFrame([(T(2024, 1, 5), None, "f", "p", "1", D(2021, 3, 1))], REPORT)
    assert accumulate(cand, prior).count() == 2
    assert accumulate(cand, None, null_safe=True).count() == 1
    assert accumulate(cand, prior, null_safe=True).count() == 0


def test_owner_as_of_transaction_time(spark):
    x = T(2024, 1, 10, 12)
    cards = spark.createDataFrame([("C1 ", "A1", T0, x - dt.timedelta(seconds=1), "N"),
                                   ("C1 ", "A2", x, FF, "N")], CARDS_HIST)
    accounts = hist(spark, ACCOUNTS_HIST, [("A1", D(2024, 1, 1), "K1"), ("A2", D(2030, 1, 1), "K1")])
    clients = hist(spark, CLIENTS_HIST, [("K1", "L", "F", "P", None, "P1", D(2030, 1, 1), "+7")])
    t = tx(spark, [("1", x - dt.timedelta(hours=1), "PAYMENT", "1", "SUCCESS", "T1"),
                   ("2", x + dt.timedelta(hours=1), "PAYMENT", "1", "SUCCESS", "T1")])
    every = owner_bridge(cards, accounts, clients, mode="all")
    at_time = owner_bridge(cards, accounts, clients, mode="as_of")
    assert events(rule_account(t, every)) == [(x - dt.timedelta(hours=1), "2"), (x + dt.timedelta(hours=1), "2")]
    assert events(rule_account(t, at_time)) == [(x - dt.timedelta(hours=1), "2")]


def test_terminal_as_of_moves_city(spark):
    b = owners(spark)
    x = T(2024, 1, 10, 12)
    term = spark.createDataFrame([("T1", "POS", "A", "x", T(2024, 1, 10), x - dt.timedelta(seconds=1), "N"),
                                  ("T1", "POS", "B", "x", x, FF, "N")], TERMINALS_HIST)
    t = tx(spark, [("0", T(2024, 1, 9, 23, 50), "PAYMENT", "1", "SUCCESS", "T1"),   # before first load
                   ("1", x - dt.timedelta(minutes=10), "PAYMENT", "1", "SUCCESS", "T1"),
                   ("2", x + dt.timedelta(minutes=10), "PAYMENT", "1", "SUCCESS", "T1")])
    assert events(rule_cities(t, term, b, terminal_mode="as_of")) == [(x + dt.timedelta(minutes=10), "3")]
    assert rule_cities(t, term, b, terminal_mode="current").count() == 0
