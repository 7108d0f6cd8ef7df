"""The four fraud rules. Each returns report candidate rows:
``event_dt, passport, fio, phone, event_type, report_dt`` plus ``_trans_id``
(the flagged transaction, used to keep NULL-key rows apart in ``report``).

Rules 1 and 2 are filters over transactions joined to the owner bridge.
Rules 3 and 4 look at a card's adjacent transactions; they use
``sequence.banded`` windows so that a card with a huge share of all
transactions is split by time band, exactly. ``all_rules`` computes all four
with a single owner join (the report's path). ``bridge`` is a DataFrame from
``owner.owner_bridge`` (modes all/current) or an ``owner.OwnerAsOf``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwarden.functions.columns import date_lit
from ledgerwarden.functions.columns import within as within_span
from ledgerwarden.operators.owner import attach_owner, version_at
from ledgerwarden.operators.sequence import BAND, GHOST, banded
from ledgerwarden.operators.sizing import broadcast_if_small
from ledgerwarden.operators.versions import resolve, validity
from ledgerwarden.schemas import (
    EVENT_ACCOUNT,
    EVENT_CITIES,
    EVENT_GUESSING,
    EVENT_PASSPORT,
    OPER_PAYMENT,
    OPER_WITHDRAW,
    RESULT_REJECT,
    RESULT_SUCCESS,
    SEED_REPORT_DATE,
)

CANDIDATE_COLUMNS = ["event_dt", "passport", "fio", "phone", "event_type", "report_dt", "_trans_id"]


def _tx(tx: DataFrame, *cols: str) -> DataFrame:
    """Transactions with the card number trimmed (the reference trims in the join)."""
    rest = [c for c in cols if c != "card_num"]
    return tx.select(F.trim("card_num").alias("card_num"), *rest)


def _candidates(df: DataFrame, event_dt: str, trans_id: str, event_type: Column | str,
                report_dt: dt.date) -> DataFrame:
    et = F.lit(event_type) if isinstance(event_type, str) else event_type
    return df.select(F.col(event_dt).alias("event_dt"), "passport", "fio", "phone",
                     et.alias("event_type"), date_lit(report_dt).alias("report_dt"),
                     F.col(trans_id).alias("_trans_id"))


def passport_condition() -> Column:
    """Rule 1: at or after the passport expiry day, or on/after its blacklisting."""
    return ((F.col("trans_date") >= F.col("passport_valid_to"))
            | (F.col("trans_date") >= F.col("blacklisted_from")))


def account_condition() -> Column:
    """Rule 2: after the account end date (midnight of it)."""
    return F.col("trans_date") > F.col("valid_to")


def with_owner(tx: DataFrame, bridge: DataFrame) -> DataFrame:
    """Transactions joined to the bridge on the trimmed card (inner, all matches)."""
    t = _tx(tx, "trans_id", "trans_date", "card_num")
    return attach_owner(t, bridge)


def rule_passport(tx: DataFrame, bridge: DataFrame, report_dt: dt.date = SEED_REPORT_DATE) -> DataFrame:
    """Transaction with an expired or blacklisted passport."""
    x = with_owner(tx, bridge).where(passport_condition())
    return _candidates(x, "trans_date", "trans_id", EVENT_PASSPORT, report_dt)


def rule_account(tx: DataFrame, bridge: DataFrame, report_dt: dt.date = SEED_REPORT_DATE) -> DataFrame:
    """Transaction on an account past its end date."""
    x = with_owner(tx, bridge).where(account_condition())
    return _candidates(x, "trans_date", "trans_id", EVENT_ACCOUNT, report_dt)


def cities_hits(tx: DataFrame, terminals: DataFrame, within="1 hour", terminal_mode: str = "all",
                band_factor: int = 6) -> DataFrame:
    """Rule 3 without owners: ``card_num, trans_date, trans_id`` of each later
    transaction whose predecessor (among transactions at a known terminal) is
    in another city at most ``within`` before."""
    t = _tx(tx, "trans_id", "trans_date", "card_num", "terminal")
    if terminal_mode == "as_of":
        # the terminal's city at the transaction time; first version reaches back
        v = validity(terminals, ["terminal_id"], extend_first=True).select(
            F.col("terminal_id").alias("terminal"), "_valid_from", "_valid_until", "terminal_city")
        x = version_at(t, v, "terminal", "trans_date", ["terminal_city"])
    else:
        term = resolve(terminals, terminal_mode).select(F.col("terminal_id").alias("terminal"),
                                                        "terminal_city")
        # the projection of ``terminals`` is no larger than it: prove (and cache) on the input
        x = t.join(broadcast_if_small(term, bounded_by=terminals), "terminal")
    aug = banded(x, "trans_date", within, "lead", band_factor)
    w = f"OVER (PARTITION BY card_num, {BAND} ORDER BY trans_date, trans_id, terminal_city)"
    y = aug.selectExpr("card_num", "trans_date", "terminal_city", GHOST,
                       f"lead(terminal_city) {w} AS lead_city", f"lead(trans_date) {w} AS lead_time",
                       f"lead(trans_id) {w} AS lead_id")
    hits = y.where(~F.col(GHOST) & (F.col("terminal_city") != F.col("lead_city"))
                   & within_span("lead_time", "trans_date", within))
    return hits.select("card_num", F.col("lead_time").alias("trans_date"),
                       F.col("lead_id").alias("trans_id"))


def guessing_hits(tx: DataFrame, within="20 minutes", rejects: int = 3,
                  band_factor: int = 6) -> DataFrame:
    """Rule 4 without owners: ``card_num, trans_date, trans_id`` of each SUCCESS
    right after ``rejects`` REJECTs with strictly falling amounts, the first of
    them at most ``within`` before it. Only WITHDRAW and PAYMENT count; other
    operations neither break nor join a chain."""
    x = (_tx(tx, "trans_id", "trans_date", "card_num", "oper_type", "amt", "oper_result")
         .where(F.col("oper_type").isin(OPER_WITHDRAW, OPER_PAYMENT)))
    aug = banded(x, "trans_date", within, "lag", band_factor)
    w = f"OVER (PARTITION BY card_num, {BAND} ORDER BY trans_date, trans_id)"
    lags = [f"lag(trans_date, {rejects}) {w} AS first_time"]
    conds = [f"NOT {GHOST}", f"oper_result = '{RESULT_SUCCESS}'", "amt_1 > amt"]
    for k in range(1, rejects + 1):
        lags += [f"lag(amt, {k}) {w} AS amt_{k}", f"lag(oper_result, {k}) {w} AS res_{k}"]
        conds.append(f"res_{k} = '{RESULT_REJECT}'")
        if k > 1:
            conds.append(f"amt_{k} > amt_{k - 1}")
    y = aug.selectExpr("card_num", "trans_id", "trans_date", "amt", "oper_result", GHOST, *lags)
    hits = y.where(" AND ".join(conds)).where(within_span("trans_date", "first_time", within))
    return hits.select("card_num", "trans_date", "trans_id")


def rule_cities(tx: DataFrame, terminals: DataFrame, bridge: DataFrame, within="1 hour",
                report_dt: dt.date = SEED_REPORT_DATE, terminal_mode: str = "all",
                band_factor: int = 6) -> DataFrame:
    """Different cities within ``within``; the event is the later transaction."""
    z = attach_owner(cities_hits(tx, terminals, within, terminal_mode, band_factor), bridge)
    return _candidates(z, "trans_date", "trans_id", EVENT_CITIES, report_dt)


def rule_guessing(tx: DataFrame, bridge: DataFrame, within="20 minutes", rejects: int = 3,
                  report_dt: dt.date = SEED_REPORT_DATE, band_factor: int = 6) -> DataFrame:
    """Amount guessing; the event is the successful transaction."""
    z = attach_owner(guessing_hits(tx, within, rejects, band_factor), bridge)
    return _candidates(z, "trans_date", "trans_id", EVENT_GUESSING, report_dt)


def all_rules(tx: DataFrame, terminals: DataFrame, bridge: DataFrame,
              report_dt: dt.date = SEED_REPORT_DATE, cities_within="1 hour",
              guessing_within="20 minutes", rejects: int = 3, terminal_mode: str = "all",
              band_factor: int = 6) -> DataFrame:
    """Candidates of all four rules with one join to the owner bridge.

    Every transaction (for rules 1-2) and the rule 3/4 hits (already tagged)
    are unioned and joined to the bridge once; one ``explode`` then emits a
    row per rule that holds.
    """
    base = _tx(tx, "trans_id", "trans_date", "card_num").withColumn("_tag", F.lit(None).cast("string"))
    r3 = cities_hits(tx, terminals, cities_within, terminal_mode, band_factor).withColumn(
        "_tag", F.lit(EVENT_CITIES))
    r4 = guessing_hits(tx, guessing_within, rejects, band_factor).withColumn(
        "_tag", F.lit(EVENT_GUESSING))
    j = attach_owner(base.unionByName(r3).unionByName(r4), bridge)
    by_filter = F.filter(F.array(F.when(passport_condition(), F.lit(EVENT_PASSPORT)),
                                 F.when(account_condition(), F.lit(EVENT_ACCOUNT))),
                         lambda x: x.isNotNull())
    rules = F.when(F.col("_tag").isNull(), by_filter).otherwise(F.array(F.col("_tag")))
    x = j.withColumn("_rule", F.explode(rules))
    return _candidates(x, "trans_date", "trans_id", F.col("_rule"), report_dt)
