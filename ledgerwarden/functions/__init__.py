"""Column expressions shared by the operators (all JVM-side, codegen'd)."""

from ledgerwarden.functions.columns import (
    amount_rounded,
    clean_amount,
    epoch_micros,
    far_future,
    full_name,
    interval_seconds,
    is_open,
    mod_time,
    date_lit,
    ntz_lit,
    time_bucket,
    typed_lit,
    within,
)

__all__ = [
    "amount_rounded", "clean_amount", "epoch_micros", "far_future", "full_name", "interval_seconds",
    "is_open", "mod_time", "time_bucket", "within", "ntz_lit", "date_lit", "typed_lit",
]
