"""Cumulative fraud report.

The reference inserts rule 1..4 candidates one after another, each time
skipping rows whose ``(event_dt, passport)`` is already in the report. That
is one pass here: keep a candidate when its event type is the smallest among
candidates with the same key, then drop keys already reported. Rows with a
NULL key never match in the reference, so each keeps its own group (salted by
its transaction and rule) instead of piling into one NULL group.

The window and the anti-join use the same key expressions, so the candidates
are shuffled once; only the prior report is shuffled to meet them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwarden.operators.rules import all_rules
from ledgerwarden.schemas import SEED_REPORT_DATE

REPORT_COLUMNS = ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
_SALT = "\u0000"


def accumulate(candidates: DataFrame, prior: DataFrame | None = None, null_safe: bool = False,
               distinct: bool = False) -> DataFrame:
    """New report rows from rule candidates (lowest rule wins per key).

    ``null_safe=True`` treats NULL event time / passport as values (a NULL
    passport is then reported once); the default reproduces the reference
    (never matched, reported again each run). ``distinct=True`` also drops
    exact duplicate candidates within a run (the reference keeps them).
    """
    tid = F.coalesce(F.col("_trans_id"), F.lit("")) if "_trans_id" in candidates.columns else F.lit("")
    if null_safe:
        k = F.coalesce(F.col("passport"), F.lit(_SALT))
    else:
        keyed = F.col("event_dt").isNotNull() & F.col("passport").isNotNull()
        k = F.when(keyed, F.col("passport")).otherwise(
            F.concat(F.lit(_SALT), tid, F.lit("|"), F.col("event_type")))
    c = candidates.withColumn("_k", k)
    w = Window.partitionBy("_k", "event_dt")
    c = c.withColumn("_min", F.min("event_type").over(w)).where(F.col("event_type") == F.col("_min"))
    if prior is not None:
        p = prior.select(F.col("event_dt").alias("_p_dt"),
                         (F.coalesce(F.col("passport"), F.lit(_SALT)) if null_safe
                          else F.col("passport")).alias("_p_k"))
        if null_safe:
            cond = (c["_k"] == p["_p_k"]) & c["event_dt"].eqNullSafe(p["_p_dt"])
        else:
            cond = (c["_k"] == p["_p_k"]) & (c["event_dt"] == p["_p_dt"])
        c = c.join(p, cond, "left_anti")
    out = c.select(*REPORT_COLUMNS)
    return out.dropDuplicates() if distinct else out


def fraud_report(tx: DataFrame, terminals: DataFrame, bridge: DataFrame,
                 prior: DataFrame | None = None, report_dt: dt.date = SEED_REPORT_DATE,
                 cities_within="1 hour", guessing_within="20 minutes", rejects: int = 3,
                 terminal_mode: str = "all", null_safe: bool = False,
                 distinct: bool = False) -> DataFrame:
    """The rows a run appends to the report (columns of ``REPORT_COLUMNS``)."""
    cand = all_rules(tx, terminals, bridge, report_dt, cities_within, guessing_within, rejects,
                     terminal_mode)
    return accumulate(cand, prior, null_safe=null_safe, distinct=distinct)
