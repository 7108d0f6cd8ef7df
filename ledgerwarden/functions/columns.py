"""Column expressions.

Each helper returns a ``Column`` built from built-in functions, so the whole
expression stays inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwarden.schemas import AMOUNT, FAR_FUTURE, FLAG_LIVE

_UNITS = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600,
          "day": 86400, "days": 86400}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def interval_seconds(span: str | int | float | dt.timedelta) -> float:
    """Seconds in ``'20 minutes'``, ``'1 hour'``, ``'3 days'``, a number or a timedelta."""
    if isinstance(span, dt.timedelta):
        return span.total_seconds()
    if isinstance(span, (int, float)):
        return float(span)
    parts = span.strip().split()
    if len(parts) != 2 or parts[1].lower() not in _UNITS:
        raise ValueError(f"unsupported interval {span!r}")
    return float(parts[0]) * _UNITS[parts[1].lower()]


def within(later: str | Column, earlier: str | Column, span) -> Column:
    """``later - earlier <= span`` (inclusive, like ``<= interval '1 hour'``)."""
    micros = int(round(interval_seconds(span) * 1_000_000))
    return (_col(later) - _col(earlier)) <= F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.lit(micros / 1_000_000).cast("decimal(18,6)"))


def ntz_lit(value: dt.datetime | dt.date | str) -> Column:
    """A zone-free ``timestamp_ntz`` literal (a Python datetime literal would
    pass through the Python process's and the session's time zones)."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = f"{value.isoformat()} 00:00:00"
    return F.expr(f"TIMESTAMP_NTZ'{value}'")


def date_lit(value: dt.date | str) -> Column:
    """A ``date`` literal."""
    if isinstance(value, dt.datetime):
        value = value.date()
    return F.expr(f"DATE'{value.isoformat() if isinstance(value, dt.date) else value}'")


def typed_lit(value, dtype: T.DataType) -> Column:
    """``value`` as a literal of ``dtype`` (zone-free for timestamps and dates)."""
    if isinstance(dtype, T.TimestampNTZType) and isinstance(value, (dt.datetime, dt.date, str)):
        return ntz_lit(value)
    if isinstance(dtype, T.DateType) and isinstance(value, (dt.date, str)):
        return date_lit(value)
    return F.lit(value).cast(dtype)


def far_future() -> Column:
    """The open end of a version, ``9999-12-31 00:00:00``."""
    return ntz_lit(FAR_FUTURE)


def is_open(effective_to: str = "effective_to") -> Column:
    """Version without a successor (live or deletion marker)."""
    return _col(effective_to) == far_future()


def is_current(effective_to: str = "effective_to", delete_flg: str = "delete_flg") -> Column:
    """The current live version: open and not deleted."""
    return is_open(effective_to) & (_col(delete_flg) == F.lit(FLAG_LIVE))


def mod_time(update_dt: str = "update_dt", create_dt: str = "create_dt") -> Column:
    """Modification time: update time, else creation time."""
    return F.coalesce(_col(update_dt), _col(create_dt))


def full_name(last: str | Column, first: str | Column, patronymic: str | Column) -> Column:
    """``last || ' ' || first || ' ' || patronymic``: NULL if any part is NULL."""
    return F.concat(_col(last), F.lit(" "), _col(first), F.lit(" "), _col(patronymic))


def clean_amount(c: str | Column, dtype: T.DecimalType = AMOUNT) -> Column:
    """Decimal comma to decimal point, typed; NULL where the text is no number or too large for ``dtype``.

    Digits behind ``dtype.scale`` places are rounded half up; ``amount_rounded`` tells where."""
    return F.regexp_replace(_col(c), ",", ".").try_cast(dtype)


def amount_rounded(c: str | Column, dtype: T.DecimalType = AMOUNT) -> Column:
    """True where ``clean_amount`` loses digits behind the point that are not zero."""
    return F.regexp_extract(_col(c), r"[.,]([0-9]*)$", 1).rlike(f"^[0-9]{{{dtype.scale}}}[0-9]*[1-9]")


def epoch_micros(c: str | Column, dtype: T.DataType) -> Column:
    """Microseconds since 1970-01-01 00:00:00 on the column's own clock.

    ``timestamp_ntz`` is zone-less, so the difference is exact in any session
    zone; ``timestamp`` uses the instant.
    """
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", ntz_lit("1970-01-01 00:00:00"), _col(c))
    return F.unix_micros(_col(c).cast(T.TimestampType()))


def time_bucket(c: str | Column, dtype: T.DataType, width_seconds: float) -> Column:
    """``floor(epoch / width)``: a coarse, monotone time key."""
    width = F.lit(int(round(width_seconds * 1_000_000)))
    us = epoch_micros(c, dtype)
    # exact integer floor division (also before 1970): (us - pmod(us, w)) / w
    return ((us - F.pmod(us, width)) / width).cast("long")
