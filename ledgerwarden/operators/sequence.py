"""Ordered neighbours per key that hold up when one key holds a third of the data.

A plain ``Window.partitionBy(key)`` puts a hot key's whole sequence into one
task, and AQE does not split window partitions. Two exact alternatives:

``banded``
    For a condition that only looks ``span`` back or ahead (rule 3: next
    transaction within an hour; rule 4: three rejects within 20 minutes).
    Rows are split into time bands of ``factor * span`` per key; rows within
    ``span`` of a band edge are copied once into the neighbouring band as
    ghosts. A window over ``(key, band)`` then sees every neighbour that can
    satisfy the condition; neighbours it cannot see are farther than ``span``
    and fail the condition anyway. The copy costs ``1/factor`` extra rows.

``neighbors``
    Exact previous / next row with no span limit (change logs). Windows run
    per ``(key, bucket)``; the row before a bucket's first row is the last row
    of the previous non-empty bucket, taken from a per-bucket summary that is
    partially aggregated before the shuffle and windowed per key (one row per
    bucket, so bounded by time range, not by data volume).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwarden.functions.columns import epoch_micros, interval_seconds, time_bucket
from ledgerwarden.operators.sizing import broadcast_if_small

BAND = "_band"
GHOST = "_ghost"
BUCKET = "_bk"


def banded(df: DataFrame, ts: str, span, direction: str, factor: int = 6) -> DataFrame:
    """Add ``_band`` and ``_ghost``; ghost rows are copies for the adjacent band.

    ``direction='lag'``: rows in the last ``span`` of a band are copied into
    the next band (they can be predecessors there). ``'lead'``: rows in the
    first ``span`` are copied into the previous band.
    Partition windows by ``keys + ['_band']`` and keep ``~_ghost`` rows.
    """
    if direction not in ("lag", "lead"):
        raise ValueError("direction must be 'lag' or 'lead'")
    span_us = int(round(interval_seconds(span) * 1_000_000))
    width_us = span_us * max(int(factor), 1)
    dtype = df.schema[ts].dataType
    if isinstance(dtype, T.TimestampNTZType):
        us = f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)"
    else:
        us = f"unix_micros(CAST(`{ts}` AS TIMESTAMP))"
    if direction == "lag":
        ghost = f"CASE WHEN _off >= {width_us - span_us} THEN _b + 1 END"
    else:
        ghost = f"CASE WHEN _off <= {span_us} THEN _b - 1 END"
    cols = [f"`{c}`" for c in df.columns]
    # epoch micros once per row; then band, offset, and one Generate for self + ghost
    d = df.selectExpr(*cols, f"{us} AS _us")
    d = d.selectExpr(*cols, f"CAST((_us - pmod(_us, {width_us})) / {width_us} AS BIGINT) AS _b",
                     f"pmod(_us, {width_us}) AS _off")
    pair = (f"explode(filter(array(named_struct('b', _b, 'g', false), named_struct('b', {ghost}, 'g', true)),"
            f" x -> x.b IS NOT NULL)) AS _bg")
    return d.selectExpr(*cols, pair).selectExpr(*cols, f"_bg.b AS {BAND}", f"_bg.g AS {GHOST}")


def neighbors(df: DataFrame, keys: list[str], order: list[str], payload: list[str],
              bucket: Column, prev: bool = True, nxt: bool = False) -> DataFrame:
    """Add ``_prev`` / ``_next``: struct(order..., payload...) of the adjacent row per key.

    ``bucket`` must be monotone in ``order`` (e.g. a coarse time bucket of the
    first order column). The rows are shuffled once by ``(key, bucket)``; the
    per-bucket summary and the final window both read that one exchange. If
    ``df`` already has ``_bk`` (a previous call's output, filtered), its
    partitioning is reused and only the small summary moves.
    """
    rec = F.struct(*[F.col(c) for c in order + payload])
    if BUCKET in df.columns:
        d = df
    else:
        # NULL keys/buckets are filtered here, before the exchange, so that
        # the join's inferred not-null filters leave both readers of the
        # exchange identical (one shuffle, reused).
        d = (df.withColumn(BUCKET, bucket)
               .where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, BUCKET]]))
               .repartition(*keys, BUCKET))
    aggs = []
    if prev:
        aggs.append(F.max(rec).alias("_last"))
    if nxt:
        aggs.append(F.min(rec).alias("_first"))
    ws = Window.partitionBy(*keys).orderBy(BUCKET)
    summ = d.groupBy(*keys, BUCKET).agg(*aggs)
    cols = [*keys, BUCKET]
    if prev:
        cols.append(F.lag("_last").over(ws).alias("_prev_last"))
    if nxt:
        cols.append(F.lead("_first").over(ws).alias("_next_first"))
    summ = summ.select(*cols)
    j = d.join(summ, on=[*keys, BUCKET], how="inner")
    # same total order as the summary's max/min of (order..., payload...): ties are deterministic
    w = Window.partitionBy(*keys, BUCKET).orderBy(*order, *payload)
    if prev:
        j = j.withColumn("_prev", F.coalesce(F.lag(rec).over(w), F.col("_prev_last")))
    if nxt:
        j = j.withColumn("_next", F.coalesce(F.lead(rec).over(w), F.col("_next_first")))
    return j.drop(*[c for c in ("_prev_last", "_next_first") if c in j.columns])


#: Rows that a (key, bucket) cell may hold before it is split by time; the share of rows that finds such cells.
HOT_ROWS, SAMPLE = 2_000_000, 0.01
_SUB = 1 << 16


def hot_cells(rows: DataFrame, keys: list[str], hot_rows: int | None = None, sample: float | None = None) -> DataFrame | None:
    """(keys, bucket, _points): split times of the cells of ``rows`` (keys, bucket, _us) with more than ``hot_rows``.

    Cells and their quantiles are estimated from a seeded sample; they decide
    where rows are put, never which rows there are. None where no cell is
    hot. At most one cell in ``hot_rows`` rows comes out.
    """
    hot, part = hot_rows or HOT_ROWS, sample or SAMPLE
    some = rows.where("_us IS NOT NULL").sample(fraction=part, seed=11) if part < 1 else rows.where("_us IS NOT NULL")
    cells = some.groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("_c"), F.percentile_approx(
        "_us", F.array(*[F.lit(i / 64) for i in range(1, 64)]), 1000).alias("_q")).where(F.col("_c") * (1 / part) > hot)
    step = F.greatest(F.lit(1), (64 * hot * part / F.col("_c")).cast("int"))       # so many 64ths of the rows make a part
    points = cells.withColumn("_step", step).select(
        *keys, BUCKET, F.expr("array_distinct(filter(_q, (q, i) -> (i + 1) % _step = 0))").alias("_points"))
    return None if points.isEmpty() else points


def split_cells(df: DataFrame, cells: DataFrame | None, keys: list[str]) -> DataFrame:
    """``df`` with its bucket refined by the split times (still rising with the time), without ``_us``."""
    if cells is None:
        return df.drop("_us")
    at = F.coalesce(F.size(F.filter("_points", lambda p: p <= F.col("_us"))), F.lit(0))
    return (df.join(broadcast_if_small(cells), [*keys, BUCKET], "left")
            .withColumn(BUCKET, F.col(BUCKET) * _SUB + F.when(F.col("_points").isNull(), 0).otherwise(at)).drop("_points", "_us"))


def asof_carry(events: DataFrame, versions: DataFrame, keys: list[str], t: str,
               version_from: str, version_order: list[str], version_payload: list[str],
               bucket_seconds: float) -> DataFrame:
    """For each event row, the latest version row with ``version_from <= t``.

    Both inputs carry ``keys``; ``events`` its time ``t``, ``versions`` their
    start ``version_from`` plus ``version_order`` tie-breaks. Output: the
    event columns plus ``_ver`` (struct of from, order, payload) or NULL.
    Linear: events and versions are sorted together per ``(key, bucket)``;
    the version in force at a bucket start comes from a per-bucket summary
    carried forward per key -- no pair of rows is ever formed. Buckets of a
    key with very many events are split by time (``hot_cells``).
    """
    ev_cols = [c for c in events.columns if c not in keys]
    tdt = events.schema[t].dataType
    vdt = versions.schema[version_from].dataType
    vrec = F.struct(F.col(version_from).alias("vf"), *[F.col(c) for c in version_order],
                    *[F.col(c) for c in version_payload])
    vtype = versions.select(vrec.alias("v")).schema["v"].dataType
    etype = events.select(F.struct(*[F.col(c) for c in ev_cols]).alias("e")).schema["e"].dataType
    v = versions.select(*keys, F.col(version_from).cast(tdt).alias("_t"), F.lit(0).alias("_side"),
                        time_bucket(version_from, vdt, bucket_seconds).alias(BUCKET),
                        vrec.alias("_v"), F.lit(None).cast(etype).alias("_e"), epoch_micros(version_from, vdt).alias("_us"))
    e = events.select(*keys, F.col(t).alias("_t"), F.lit(1).alias("_side"),
                      time_bucket(t, tdt, bucket_seconds).alias(BUCKET),
                      F.lit(None).cast(vtype).alias("_v"), F.struct(*[F.col(c) for c in ev_cols]).alias("_e"),
                      epoch_micros(t, tdt).alias("_us"))
    not_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, BUCKET]])
    v, e = v.where(not_null), e.where(not_null)
    cells = hot_cells(e.select(*keys, BUCKET, "_us"), keys)
    v, e = split_cells(v, cells, keys), split_cells(e, cells, keys)
    u = v.unionByName(e).repartition(*keys, BUCKET)   # the one big shuffle, read once
    # Bucket summary from the same shuffle: the latest version of each bucket. It uses every column of the
    # shuffled rows, so that pruning leaves both readers alike: one exchange, its inputs computed once.
    latest = F.max(F.when(F.col("_side") == 0, F.struct("_t", "_v")))
    summ = u.groupBy(*keys, BUCKET).agg(latest.alias("_l"), F.count("_e").alias("_n"))
    summ = summ.where((F.col("_n") > 0) | F.col("_l").isNotNull()).select(*keys, BUCKET, F.col("_l._v").alias("_last"))
    ws = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select(*keys, BUCKET, F.last("_last", ignorenulls=True).over(ws).alias("_carry"))
    j = u.join(summ, on=[*keys, BUCKET], how="inner")
    w = (Window.partitionBy(*keys, BUCKET).orderBy("_t", "_side", "_v")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    j = j.withColumn("_ver", F.coalesce(F.last("_v", ignorenulls=True).over(w), F.col("_carry")))
    return j.where(F.col("_side") == 1).select(*keys, "_e.*", "_ver")
