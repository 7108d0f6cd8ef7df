"""Which versions of an SCD2 history a lookup sees (reference: all of them)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import Window

from ledgerwarden.functions.columns import far_future, interval_seconds, is_current, is_open, ntz_lit
from ledgerwarden.schemas import FLAG_LIVE

BEGINNING = "0001-01-01 00:00:00"

MODES = ("all", "current", "live", "as_of")


def resolve(hist: DataFrame, mode: str = "all", at: dt.datetime | None = None) -> DataFrame:
    """Filter a history to the versions a join should see.

    ``all``      every version (the reference's owner chain and terminal join);
    ``current``  the open, not deleted version per key;
    ``live``     every not-deleted version (``delete_flg = 'N'``);
    ``as_of``    the version valid at ``at`` (``effective_from <= at <= effective_to``,
                 ends are inclusive as in the reference, which closes at start - 1 s).
    Tables without SCD2 columns pass through unchanged.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if "effective_to" not in hist.columns or mode == "all":
        return hist
    if mode == "current":
        return hist.where(is_current())
    if mode == "live":
        return hist.where(F.col("delete_flg") == F.lit(FLAG_LIVE))
    if at is None:
        raise ValueError("as_of needs a time")
    ts = ntz_lit(at)
    return hist.where((F.col("effective_from") <= ts)
                      & ((F.col("effective_to") >= ts) | is_open())
                      & (F.col("delete_flg") == F.lit(FLAG_LIVE)))


def validity(hist: DataFrame, keys: list[str], unit="1 second", extend_first: bool = False) -> DataFrame:
    """Live versions with a half-open validity ``[_valid_from, _valid_until)``.

    ``_valid_until`` is the stored end plus ``unit`` (the reference closes a
    version one unit before its successor starts), far future when open.
    ``extend_first=True`` lets each key's first version reach back to the
    beginning of time: terminals are stamped with their load time, usually
    """
    live = hist.where(F.col("delete_flg") == F.lit(FLAG_LIVE))
    secs = interval_seconds(unit)
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(secs).cast("decimal(18,6)"))
    until = F.when(is_open(), far_future()).otherwise(F.col("effective_to") + step)
    start = F.col("effective_from")
    if extend_first:
        first = F.min("effective_from").over(Window.partitionBy(*keys))
        start = F.when(start == first, ntz_lit(BEGINNING)).otherwise(start)
    return live.withColumn("_valid_from", start).withColumn("_valid_until", until)
