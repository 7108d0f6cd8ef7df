"""Rows a run refuses: marked with a reason and kept as they came.

Refused rows travel in the write of the accepted ones: ``_part`` holds the
reason (it becomes a folder), ``_source`` the feed, ``_row`` the row as JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwarden.functions.columns import amount_rounded, clean_amount, mod_time, typed_lit
from ledgerwarden.plans.state import LOADED, PART
from ledgerwarden.schemas import TRANSACTIONS_FACT
from ledgerwarden.sources.feeds import clean_transactions, wall_clock


def _as_it_came(df: DataFrame):
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})


def refused_changes(src: DataFrame, keys: list[str], watermark, source: str, update_dt: str = "update_dt",
                    create_dt: str = "create_dt") -> DataFrame:
    """Source rows a change merge cannot use: a NULL key among the rows past ``watermark``, or no modification time."""
    no_key = ~_all_set(keys)
    at = mod_time(update_dt, create_dt)
    fresh = at > typed_lit(watermark, src.schema[create_dt].dataType)
    reason = F.when(at.isNull(), F.lit("null_time")).otherwise(F.lit("null_key"))
    return src.where(at.isNull() | (no_key & fresh)).select(
        reason.alias(PART), F.lit(source).alias("_source"), _as_it_came(src).alias("_row"))


def refused_keys(rows: DataFrame, keys: list[str], source: str) -> DataFrame:
    """Rows of a snapshot or fact feed without a key."""
    return refused_rows(rows.where(~_all_set(keys)), "null_key", source)


def refused_rows(rows: DataFrame, reason: str, source: str) -> DataFrame:
    return rows.select(F.lit(reason).alias(PART), F.lit(source).alias("_source"), _as_it_came(rows).alias("_row"))


def _all_set(keys: list[str]):
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def judged_transactions(raw: DataFrame, source: str = "transactions", ts_format: str | None = None) -> DataFrame:
    """The typed rows of a raw transaction feed, and its refused ones, marked by ``_part``; one pass.

    Refused: no id, no time, an unreadable time or amount (the first that holds). An amount that
    loses digits is loaded rounded and kept as it came as well. A missing amount is loaded as NULL.
    """
    def blank(c):
        return F.coalesce(F.trim(c), F.lit("")) == ""

    amount = F.trim("amount")
    reason = (F.when(blank("transaction_id"), F.lit("null_key"))
              .when(blank("transaction_date"), F.lit("null_time"))
              .when(wall_clock(F.trim("transaction_date"), ts_format).isNull(), F.lit("unreadable_time"))
              .when(~blank("amount") & clean_amount(amount).isNull(), F.lit("unreadable_amount")))
    told = clean_transactions(raw.withColumn("_reason", reason).withColumn("_row", _as_it_came(raw))
                              .withColumn("_rounded", F.coalesce(amount_rounded(amount), F.lit(False))),
                              ["_reason", "_row", "_rounded"], ts_format)
    parts = F.filter(F.array(F.when(F.col("_reason").isNull(), F.lit(LOADED)),
                             F.coalesce(F.col("_reason"), F.when(F.col("_rounded"), F.lit("rounded_amount")))),
                     lambda p: p.isNotNull())
    rows = told.withColumn(PART, F.explode(parts))
    loaded = F.col(PART) == LOADED
    return rows.select(*[F.when(loaded, F.col(f.name)).cast(f.dataType).alias(f.name) for f in TRANSACTIONS_FACT.fields],
                       PART, F.when(~loaded, F.lit(source)).alias("_source"), F.when(~loaded, F.col("_row")).alias("_row"))
