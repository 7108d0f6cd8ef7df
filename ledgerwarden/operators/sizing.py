"""Broadcast only behind a size check.

``F.broadcast`` forces a broadcast whatever the size; here a side is hinted
only when its size is bounded by measuring it (file and join estimates say
little about the size in memory): one small aggregate job, run while the plan
is built, gives the row count and the longest value of every variable-width
column, i.e. an upper bound of the broadcast size. Above the bound the join
stays a shuffle join (AQE may still convert it, and splits skewed partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 24


def _fixed_width(t: T.DataType) -> int:
    if isinstance(t, (T.BooleanType, T.ByteType)):
        return 1
    if isinstance(t, (T.ShortType,)):
        return 2
    if isinstance(t, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(t, T.DecimalType):
        return 8 if t.precision <= 18 else 16
    return 8   # long, double, timestamps, intervals


def measured_bytes(df: DataFrame) -> int:
    """Upper bound of ``df``'s in-memory size from one aggregate job.

    Variable-width columns (strings, binary) count with their longest value;
    nested columns are measured through their JSON text. The bound is kept on
    the DataFrame object: its input files were listed when it was created, so
    a second measurement of the same object would read the same data.
    """
    known = getattr(df, "_lw_measured_bytes", None)
    if known is not None:
        return known
    fields = df.schema.fields
    var = [f.name for f in fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    nested = [f.name for f in fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    fixed = sum(_fixed_width(f.dataType) for f in fields if f.name not in var and f.name not in nested)
    var_len = [F.length(c) for c in var] + [F.length(F.to_json(c)) for c in nested]
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 *[F.max(e).alias(f"m{i}") for i, e in enumerate(var_len)]).first()
    widest = sum((row[f"m{i}"] or 0) for i in range(len(var_len)))
    bound = int(row["n"]) * (fixed + widest + _ROW_OVERHEAD)
    try:
        df._lw_measured_bytes = bound
    except AttributeError:  # pragma: no cover - objects without a __dict__
        pass
    return bound


def is_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` is measured to take at most ``max_bytes``."""
    return measured_bytes(df) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                       bounded_by: DataFrame | None = None) -> DataFrame:
    """Hint a broadcast when the size is known to be at most ``max_bytes``.

    ``bounded_by``: a DataFrame that ``df`` is a projection/filter of; its
    (cached) bound is used instead of measuring ``df`` itself.
    """
    return F.broadcast(df) if is_small(bounded_by if bounded_by is not None else df, max_bytes) else df
