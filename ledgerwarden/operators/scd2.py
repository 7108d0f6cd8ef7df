"""SCD type 2 history as pure DataFrame functions.

A history has the key columns, the tracked columns and ``effective_from``,
``effective_to`` (``9999-12-31`` while open) and ``delete_flg`` (``N`` live,
``Y`` deletion marker). A run only touches the *open* rows (one per key); the
closed rows pass through untouched, so a writer can append the newly closed
rows and rewrite only the open part (see ``plans.state``).

Merges cogroup the open rows with the batch by ``union`` + ``groupBy(key)``:
one shuffle for all inputs, partially aggregated before it (a key repeated a
million times in a change batch is collapsed map-side to its latest change),
and each key then expands into its 0-3 output rows with one ``inline``.

Q1/Q16 the close and the open come from the same joined row, times stay
timestamps; Q2 only the open version is closed on delete; Q3 deletion is
guarded by the key's own history; Q4 NULL keys are dropped; Q5 replaying a
batch changes nothing (changes not newer than the open version are ignored);
Q17 a deleted key that comes back stays deleted unless ``reopen=True``.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwarden.functions.columns import epoch_micros, far_future, interval_seconds, is_open, ntz_lit, time_bucket
from ledgerwarden.operators.sequence import BUCKET, asof_carry, hot_cells, split_cells
from ledgerwarden.schemas import FAR_FUTURE, FLAG_DELETED, FLAG_LIVE

SCD2 = ["effective_from", "effective_to", "delete_flg"]


def _span(unit) -> Column:
    secs = interval_seconds(unit)
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(secs).cast("decimal(18,6)"))


def _ts(value) -> Column:
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return ntz_lit(value)


def _not_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def split_history(hist: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(closed rows, open rows)."""
    return hist.where(~is_open()), hist.where(is_open())


def initial_history(rows: DataFrame, keys: list[str], tracked: list[str], effective_from) -> DataFrame:
    """A first load: every row opens a live version at ``effective_from``."""
    return rows.where(_not_null(keys)).select(
        *keys, *tracked, _ts(effective_from).alias("effective_from"),
        far_future().alias("effective_to"), F.lit(FLAG_LIVE).alias("delete_flg"))


# --------------------------------------------------------------------------- SQL text helpers
# The merges build their per-key expansion as SQL expressions: one parse on
# the JVM side instead of a JVM call per column reference.

def _ts_sql(value) -> str:
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP_NTZ'{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"TIMESTAMP_NTZ'{value.isoformat()} 00:00:00'"
    return f"CAST('{value}' AS TIMESTAMP_NTZ)"


FF_SQL = _ts_sql(FAR_FUTURE)


def _span_sql(unit) -> str:
    return f"INTERVAL '{interval_seconds(unit)}' SECOND"


def _ddl(fields: list[tuple[str, T.DataType]]) -> str:
    return "struct<" + ",".join(f"`{n}`:{t.simpleString()}" for n, t in fields) + ">"


def _struct_sql(fields: list[tuple[str, str]]) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in fields) + ")"


def _diff_sql(a: str, b: str, tracked: list[str]) -> str:
    if not tracked:
        return "false"
    return "(" + " OR ".join(f"NOT ({a}.`{c}` <=> {b}.`{c}`)" for c in tracked) + ")"


def _row_sql(keys, tracked, src: str, eff_from: str, eff_to: str, flag: str) -> str:
    return _struct_sql([(k, f"`{k}`") for k in keys] + [(c, f"{src}.`{c}`") for c in tracked]
                       + [("effective_from", eff_from), ("effective_to", eff_to), ("delete_flg", flag)])


def _emit_sql(g: DataFrame, rows: list[str], refused: str | None = None) -> DataFrame:
    """The rows of each group; ``refused`` (an empty row) stands for each row of a refused group."""
    kept = f"filter(array({', '.join(rows)}), x -> x IS NOT NULL)"
    if refused is None:
        return g.selectExpr(f"inline({kept})")
    return g.selectExpr("_part", "_row", f"inline(CASE WHEN _row IS NULL THEN {kept} ELSE array_repeat({refused}, CAST(_n AS INT)) END)")


def _key_cols(hist: DataFrame, keys: list[str]) -> list[str]:
    return [f"CAST(`{k}` AS {hist.schema[k].dataType.simpleString()}) AS `{k}`" for k in keys]


def _not_null_sql(keys: list[str]) -> str:
    return " AND ".join(f"`{k}` IS NOT NULL" for k in keys)


# --------------------------------------------------------------------------- snapshot merge (O2)

def cogroup_snapshot(hist: DataFrame, snapshot: DataFrame, keys: list[str],
                     tracked: list[str]) -> DataFrame:
    """One row per key: ``o`` (open version or NULL), ``s`` (snapshot row or NULL), ``action``.

    Actions: new, changed, deleted, same, stays_deleted, returned.
    """
    _, opened = split_history(hist)
    sch = {f.name: f.dataType for f in hist.schema.fields}
    o_fields = tracked + ["effective_from", "delete_flg"]
    o_ddl = _ddl([(c, sch[c]) for c in o_fields])
    s_ddl = _ddl([(c, sch[c]) for c in tracked])
    o = opened.selectExpr(*[f"`{k}`" for k in keys], _struct_sql([(c, f"`{c}`") for c in o_fields]) + " AS o",
                          f"CAST(NULL AS {s_ddl}) AS s")
    snap = snapshot.where(_not_null_sql(keys)).selectExpr(
        *_key_cols(hist, keys), f"CAST(NULL AS {o_ddl}) AS o",
        _struct_sql([(c, f"CAST(`{c}` AS {sch[c].simpleString()})") for c in tracked]) + " AS s")
    g = o.unionByName(snap).groupBy(*keys).agg(F.max("o").alias("o"), F.max("s").alias("s"))
    live = f"(o IS NOT NULL AND o.delete_flg = '{FLAG_LIVE}')"
    action = (f"CASE WHEN o IS NULL AND s IS NOT NULL THEN 'new' "
              f"WHEN {live} AND s IS NOT NULL AND {_diff_sql('o', 's', tracked)} THEN 'changed' "
              f"WHEN {live} AND s IS NOT NULL THEN 'same' "
              f"WHEN {live} THEN 'deleted' "
              f"WHEN o IS NOT NULL AND s IS NOT NULL THEN 'returned' "
              f"ELSE 'stays_deleted' END AS action")
    return g.selectExpr("*", action)


def scd2_snapshot_delta(hist: DataFrame, snapshot: DataFrame, keys: list[str], tracked: list[str],
                        run_ts, unit="1 second", reopen: bool = False) -> DataFrame:
    """The new open part plus the versions this run closes (the rows to write)."""
    g = cogroup_snapshot(hist, snapshot, keys, tracked)
    run = _ts_sql(run_ts)
    closed_at = f"({run} - {_span_sql(unit)})"
    n, y = f"'{FLAG_LIVE}'", f"'{FLAG_DELETED}'"
    revive = "(action = 'returned')" if reopen else "false"

    def row(src, frm, to, flag):
        return _row_sql(keys, tracked, src, frm, to, flag)
    first = (f"CASE WHEN action = 'new' THEN {row('s', run, FF_SQL, n)} "
             f"WHEN action IN ('changed', 'deleted') THEN {row('o', 'o.effective_from', closed_at, n)} "
             f"WHEN {revive} THEN {row('o', 'o.effective_from', closed_at, y)} "
             f"ELSE {row('o', 'o.effective_from', FF_SQL, 'o.delete_flg')} END")
    second = (f"CASE WHEN action = 'changed' OR {revive} THEN {row('s', run, FF_SQL, n)} "
              f"WHEN action = 'deleted' THEN {row('o', run, FF_SQL, y)} END")
    return _emit_sql(g, [first, second])


def scd2_merge_snapshot(hist: DataFrame, snapshot: DataFrame, keys: list[str], tracked: list[str],
                        run_ts, unit="1 second", reopen: bool = False) -> DataFrame:
    """O2: merge a full snapshot taken at ``run_ts`` into the history."""
    closed, _ = split_history(hist)
    delta = scd2_snapshot_delta(hist, snapshot, keys, tracked, run_ts, unit, reopen)
    return closed.unionByName(delta)


# --------------------------------------------------------------------------- change feed merge (O1)

def scd2_cdc_delta(hist: DataFrame, changes: DataFrame, keys: list[str], tracked: list[str],
                   change_ts: str = "mod_dt", live_keys: DataFrame | None = None, run_ts=None,
                   unit="1 second", reopen: bool = False, whole: bool = False) -> DataFrame:
    """Rows to write for a change batch plus the source's live key list.

    ``whole``: ``changes`` has a row for every live key, without a change time
    where it has not changed (``extract.source_changes``); its refused rows, if any, pass through with
    ``_part`` and ``_row``.

    Per key the latest change in the batch applies (ties: larger values);
    a change not newer than the open version is ignored (replays are no-ops).
    Keys of the history missing from ``live_keys`` are closed at
    ``run_ts - unit`` and get a ``Y`` marker from ``run_ts``.
    """
    if (whole or live_keys is not None) and run_ts is None:
        raise ValueError("deletes need run_ts")
    extra = [c for c in ("_part", "_row") if whole and c in changes.columns]
    used = f"{_not_null_sql(keys)}" + ("" if whole else f" AND `{change_ts}` IS NOT NULL") + (" OR _row IS NOT NULL" if extra else "")
    changed = f"`{change_ts}` IS NOT NULL" + (" AND _row IS NULL" if extra else "")
    _, opened = split_history(hist)
    sch = {f.name: f.dataType for f in hist.schema.fields}
    o_fields = tracked + ["effective_from", "delete_flg"]
    o_ddl = _ddl([(c, sch[c]) for c in o_fields])
    c_ddl = _ddl([("ts", T.TimestampNTZType())] + [(c, sch[c]) for c in tracked])
    c_struct = _struct_sql([("ts", f"CAST(`{change_ts}` AS TIMESTAMP_NTZ)")]
                           + [(c, f"CAST(`{c}` AS {sch[c].simpleString()})") for c in tracked])
    parts = [
        opened.selectExpr(*[f"`{k}`" for k in keys], _struct_sql([(c, f"`{c}`") for c in o_fields]) + " AS o",
                          f"CAST(NULL AS {c_ddl}) AS c", "CAST(NULL AS BOOLEAN) AS live",
                          *[f"CAST(NULL AS STRING) AS {x}" for x in extra]),
        changes.where(used).selectExpr(
            *_key_cols(hist, keys), f"CAST(NULL AS {o_ddl}) AS o", f"CASE WHEN {changed} THEN {c_struct} END AS c",
            f"CAST({'true' if whole else 'NULL'} AS BOOLEAN) AS live", *extra),
    ]
    if live_keys is not None:
        parts.append(live_keys.where(_not_null_sql(keys)).selectExpr(
            *_key_cols(hist, keys), f"CAST(NULL AS {o_ddl}) AS o", f"CAST(NULL AS {c_ddl}) AS c",
            "true AS live"))
    u = reduce(DataFrame.unionByName, parts)
    counted = [F.max("_part").alias("_part"), F.count(F.lit(1)).alias("_n")] if extra else []
    g = u.groupBy(*keys, *extra[1:]).agg(F.max("o").alias("o"), F.max("c").alias("c"), F.max("live").alias("live"), *counted)
    # per-key state, then the rows it expands to
    g = g.selectExpr(
        "*",
        "(o IS NOT NULL) AS has_o",
        f"(o IS NOT NULL AND o.delete_flg = '{FLAG_LIVE}') AS o_live",
        f"(o IS NOT NULL AND o.delete_flg = '{FLAG_DELETED}') AS o_del",
        "(c IS NOT NULL AND (o IS NULL OR c.ts > o.effective_from)) AS has_c")
    g = g.selectExpr(
        "*", "(NOT has_o AND has_c) AS is_new",
        f"(o_live AND has_c AND {_diff_sql('o', 'c', tracked)}) AS chg",
        f"({'true' if reopen else 'false'} AND o_del AND has_c) AS revive")
    live = "true" if live_keys is None and not whole else "coalesce(live, false)"
    g = g.selectExpr(
        "*", "(is_new OR chg OR revive) AS takes_c",
        f"(NOT {live} AND (has_o OR is_new) AND "
        f"(CASE WHEN is_new OR chg OR revive THEN '{FLAG_LIVE}' ELSE o.delete_flg END) = '{FLAG_LIVE}')"
        " AS del")
    run = _ts_sql(run_ts) if run_ts is not None else "CAST(NULL AS TIMESTAMP_NTZ)"
    step = _span_sql(unit)
    n, y = f"'{FLAG_LIVE}'", f"'{FLAG_DELETED}'"
    end = f"(CASE WHEN del THEN {run} - {step} ELSE {FF_SQL} END)"

    def row(src, frm, to, flag):
        return _row_sql(keys, tracked, src, frm, to, flag)
    closed_old = (f"CASE WHEN chg THEN {row('o', 'o.effective_from', f'c.ts - {step}', n)} "
                  f"WHEN revive THEN {row('o', 'o.effective_from', f'c.ts - {step}', y)} END")
    current = (f"CASE WHEN takes_c THEN {row('c', 'c.ts', end, n)} "
               f"WHEN has_o THEN {row('o', 'o.effective_from', end, 'o.delete_flg')} END")
    marker = (f"CASE WHEN del AND takes_c THEN {row('c', run, FF_SQL, y)} "
              f"WHEN del THEN {row('o', run, FF_SQL, y)} END")
    empty = _struct_sql([(c, f"CAST(NULL AS {sch[c].simpleString()})") for c in [*keys, *tracked, *SCD2]]) if extra else None
    return _emit_sql(g, [closed_old, current, marker], empty)


def scd2_merge(hist: DataFrame, changes: DataFrame, keys: list[str], tracked: list[str],
               change_ts: str = "mod_dt", live_keys: DataFrame | None = None, run_ts=None,
               unit="1 second", reopen: bool = False) -> DataFrame:
    """O1: merge an incremental change extract (+ live keys for deletes)."""
    closed, _ = split_history(hist)
    delta = scd2_cdc_delta(hist, changes, keys, tracked, change_ts, live_keys, run_ts, unit, reopen)
    return closed.unionByName(delta)


def scd2_merge_log(hist: DataFrame, changes: DataFrame, keys: list[str], tracked: list[str],
                   change_ts: str = "mod_dt", live_keys: DataFrame | None = None, run_ts=None,
                   unit="1 second", bucket="365 days") -> DataFrame:
    """O1 for real change feeds: every change of the batch becomes a version, not only a key's latest.

    The open live rows and the changes form one log for ``scd2_from_log``, so
    a key with very many changes is spread over time buckets. Changes not
    newer than the key's open version are ignored (replays are no-ops), as
    are those of deleted keys, and rows with a NULL key or time
    (``dropped_changes`` counts them). Of changes of one key at one time the
    largest tracked values stay. Keys missing from ``live_keys`` are closed
    at ``run_ts - unit`` and get a ``Y`` marker from ``run_ts``.
    """
    if live_keys is not None and run_ts is None:
        raise ValueError("deletes need run_ts")
    closed, opened = split_history(hist)
    types = {f.name: f.dataType for f in hist.schema.fields}
    at = F.col(change_ts).cast("timestamp_ntz")
    batch = changes.where(_not_null(keys) & at.isNotNull()).select(
        *[F.col(k).cast(types[k]).alias(k) for k in keys], at.alias("effective_from"),
        F.struct(*[F.col(c).cast(types[c]).alias(c) for c in tracked]).alias("_a"))
    batch = batch.groupBy(*keys, "effective_from").agg(F.max("_a").alias("_a"))
    state = opened.select(*keys, F.col("effective_from").alias("_since"), F.col("delete_flg").alias("_flg"))
    fresh = F.col("_since").isNull() | ((F.col("_flg") == FLAG_LIVE) & (F.col("effective_from") > F.col("_since")))
    batch = batch.join(state, keys, "left").where(fresh).select(*keys, "_a.*", "effective_from")
    live_now = opened.where(F.col("delete_flg") == FLAG_LIVE)
    log = live_now.select(*keys, *tracked, "effective_from").unionByName(batch)
    versions = scd2_from_log(log, keys, tracked, "effective_from", unit=unit, bucket=bucket)
    out = closed.unionByName(opened.where(F.col("delete_flg") == FLAG_DELETED)).select(*versions.columns)
    if live_keys is None:
        return out.unionByName(versions)
    known = live_keys.where(_not_null(keys)).select(
        *[F.col(k).cast(types[k]).alias(k) for k in keys], F.lit(True).alias("_live")).distinct()
    v = versions.join(known, keys, "left")
    ends = is_open() & F.col("_live").isNull()
    row = F.struct(*[F.col(c) for c in [*keys, *tracked]], "effective_from",
                   F.when(ends, _ts(run_ts) - _span(unit)).otherwise(F.col("effective_to")).alias("effective_to"),
                   "delete_flg")
    marker = F.when(ends, F.struct(*[F.col(c) for c in [*keys, *tracked]], _ts(run_ts).alias("effective_from"),
                                   far_future().alias("effective_to"), F.lit(FLAG_DELETED).alias("delete_flg")))
    rows = v.select(F.explode(F.filter(F.array(row, marker), lambda r: r.isNotNull())).alias("r")).select("r.*")
    return out.unionByName(rows)


def dropped_changes(changes: DataFrame, keys: list[str], change_ts: str = "mod_dt") -> DataFrame:
    """How many rows of a batch a merge leaves out, one row: ``n_rows``, ``n_null_key``, ``n_null_time``
    (with a key). A run that must not lose rows silently checks it before merging."""
    keyed = _not_null(keys)
    return changes.select(keyed.alias("k"), F.col(change_ts).isNotNull().alias("t")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("k")).alias("n_null_key"),
        F.count_if(F.col("k") & ~F.col("t")).alias("n_null_time"))


# --------------------------------------------------------------------------- whole backlog (O3)

def scd2_from_log(log: DataFrame, keys: list[str], tracked: list[str], ts: str,
                  tiebreak: list[str] | None = None, unit="1 second",
                  bucket="30 days") -> DataFrame:
    """O3: history from a change log in one job (gaps and islands).

    A row opens a version when it is a key's first row or any tracked value
    differs from the key's previous row (by ``ts``, then ``tiebreak``).
    ``effective_to`` is the next version's start minus ``unit``.

    The rows are shuffled once, by key and ``bucket``-wide time bucket, so a
    key with a huge log is spread over many tasks; a bucket with very many rows of a key is split
    by time at sampled quantiles (``sequence.hot_cells``). Inside a bucket only two
    versions depend on other buckets: the one its first row may open and its
    last one's end. They come from a summary of one row per key and bucket
    (built where the rows are, then windowed per key); all other versions are
    complete within their bucket.
    """
    order = [ts] + list(tiebreak or [])
    bk = time_bucket(ts, log.schema[ts].dataType, interval_seconds(bucket))
    d = (log.where(_not_null(keys) & F.col(ts).isNotNull())
         .select(*keys, *tracked, *order, bk.alias(BUCKET), epoch_micros(ts, log.schema[ts].dataType).alias("_us")))
    d = split_cells(d, hot_cells(d.select(*keys, BUCKET, "_us"), keys), keys).repartition(*keys, BUCKET)
    rec = F.struct(*[F.col(c) for c in order + tracked])

    def differs(a: str, b: str) -> Column:
        return reduce(lambda x, y: x | y, [~F.col(a)[c].eqNullSafe(F.col(b)[c]) for c in tracked] or [F.lit(False)])
    w = Window.partitionBy(*keys, BUCKET).orderBy(*order, *tracked)
    d = d.select(*keys, BUCKET, rec.alias("_r"), F.lag(rec).over(w).alias("_p"))
    d = d.select(*keys, BUCKET, "_r", (F.col("_p").isNotNull() & differs("_r", "_p")).alias("_chg"))
    inner = d.where("_chg").select(
        *keys, "_r", F.lead("_r").over(Window.partitionBy(*keys, BUCKET).orderBy("_r"))[ts].alias("_end"))
    inner = inner.where(F.col("_end").isNotNull())
    change = F.when(F.col("_chg"), F.col("_r"))
    summ = d.groupBy(*keys, BUCKET).agg(F.min("_r").alias("_first"), F.max("_r").alias("_last"),
                                        F.min(change).alias("_c1"), F.max(change).alias("_cn"))
    wk = Window.partitionBy(*keys).orderBy(BUCKET)
    summ = summ.select("*", F.lag("_last").over(wk).alias("_before"))
    summ = summ.select("*", (F.col("_before").isNull() | differs("_first", "_before")).alias("_opens"))
    start = F.when(F.col("_opens"), F.col("_first")[ts]).otherwise(F.col("_c1")[ts])
    summ = summ.withColumn("_start", start)
    summ = summ.withColumn("_after", F.first("_start", ignorenulls=True).over(
        wk.rowsBetween(1, Window.unboundedFollowing)))
    edges = F.array(
        F.when(F.col("_opens"), F.struct(F.col("_first").alias("_r"),
                                         F.coalesce(F.col("_c1")[ts], F.col("_after")).alias("_end"))),
        F.when(F.col("_cn").isNotNull(), F.struct(F.col("_cn").alias("_r"), F.col("_after").alias("_end"))))
    outer = summ.select(*keys, F.explode(F.filter(edges, lambda e: e.isNotNull())).alias("_e")).select(*keys, "_e.*")
    v = inner.unionByName(outer)
    end = F.when(F.col("_end").isNull(), far_future()).otherwise(F.col("_end") - _span(unit))
    return v.select(*keys, *[F.col("_r")[c].alias(c) for c in tracked],
                    F.col("_r")[ts].cast("timestamp_ntz").alias("effective_from"),
                    end.cast("timestamp_ntz").alias("effective_to"), F.lit(FLAG_LIVE).alias("delete_flg"))


#: Snapshot dates that are numbered on the driver (270 years of days); more are numbered by a window.
MAX_DATES = 100_000


def _numbered_dates(dates: DataFrame) -> DataFrame:
    """(_sts, _i, _next_sts, _n): the distinct dates numbered from 1, broadcast behind their count."""
    distinct = dates.where("_sts IS NOT NULL").distinct()
    known = sorted(r["_sts"] for r in distinct.limit(MAX_DATES + 1).collect())
    if len(known) <= MAX_DATES:
        rows = [(d, i, known[i] if i < len(known) else None, len(known)) for i, d in enumerate(known, 1)]
        return F.broadcast(dates.sparkSession.createDataFrame(
            rows, "_sts timestamp_ntz, _i int, _next_sts timestamp_ntz, _n long"))
    wd = Window.orderBy("_sts")
    return distinct.select("_sts", F.row_number().over(wd).alias("_i"), F.lead("_sts").over(wd).alias("_next_sts"),
                           F.count(F.lit(1)).over(Window.partitionBy()).alias("_n"))


def scd2_from_snapshots(snapshots: DataFrame, keys: list[str], tracked: list[str], snap_ts: str,
                        unit="1 second") -> DataFrame:
    """O3 over a series of full snapshots (what running O2 once per snapshot gives).

    Snapshots are numbered 1..n (one row per snapshot date, broadcast back); the
    rows are read once, and their date column alone once before;
    a key is kept up to its first gap (a deleted key stays deleted), opens a
    version on change, and gets a ``Y`` marker at the snapshot after its last
    appearance when that is not the last snapshot. Rows per key are at most
    the number of snapshots, so a window per key is bounded.
    """
    x = (snapshots.where(_not_null(keys))
         .select(*keys, *tracked, F.col(snap_ts).cast("timestamp_ntz").alias("_sts"))
         .join(_numbered_dates(snapshots.select(F.col(snap_ts).cast("timestamp_ntz").alias("_sts"))), "_sts"))
    w = Window.partitionBy(*keys).orderBy("_i")
    prev = F.struct(*[F.lag(c).over(w).alias(c) for c in tracked])
    x = x.select("*", F.lag("_i").over(w).alias("_pi"), F.lead("_i").over(w).alias("_ni"),
                 prev.alias("_pa"))
    gap = F.when(F.col("_i") - F.col("_pi") > 1, 1).otherwise(0)
    x = x.withColumn("_gp", F.sum(gap).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    x = x.where(F.col("_gp") == 0)
    cur = F.struct(*[F.col(c) for c in tracked])
    is_ver = F.col("_pi").isNull() | reduce(
        lambda a, b: a | b, [~F.col("_pa")[c].eqNullSafe(F.col(c)) for c in tracked] or [F.lit(False)])
    last_kept = F.col("_ni").isNull() | (F.col("_ni") - F.col("_i") > 1)
    gone = last_kept & (F.col("_i") < F.col("_n"))
    ver = F.when(is_ver, F.struct(cur.alias("a"), F.col("_sts").alias("f"), F.lit(FLAG_LIVE).alias("d")))
    mark = F.when(gone, F.struct(cur.alias("a"), F.col("_next_sts").alias("f"), F.lit(FLAG_DELETED).alias("d")))
    rows = x.select(*keys, F.explode(F.filter(F.array(ver, mark), lambda r: r.isNotNull())).alias("r"))
    rows = rows.select(*keys, "r.a.*", F.col("r.f").alias("effective_from"), F.col("r.d").alias("delete_flg"))
    wv = Window.partitionBy(*keys).orderBy("effective_from", "delete_flg")
    nxt = F.lead("effective_from").over(wv)
    end = F.when(nxt.isNull(), far_future()).otherwise(nxt - _span(unit))
    return rows.select(*keys, *tracked, "effective_from", end.alias("effective_to"), "delete_flg")


# --------------------------------------------------------------------------- lookups

def scd2_as_of(events: DataFrame, hist: DataFrame, keys: list[str], at: str, payload: list[str],
               unit="1 second", bucket="30 days", how: str = "inner") -> DataFrame:
    """Attach to each event the version of its key in force at ``events[at]``.

    In force: ``effective_from <= at`` and ``at < effective_to + unit`` (the
    reference closes a version at the next start minus ``unit``). With
    ``how="left"`` events without a version, key or time stay. Linear in
    events + versions; no key's rows are paired with each other.
    """
    v = hist.where(_not_null(keys)).select(*keys, "effective_from", "effective_to", "delete_flg",
                                           *payload)
    got = asof_carry(events, v, keys, at, "effective_from", ["effective_to"],
                     ["delete_flg", *payload], interval_seconds(bucket))
    ver = F.col("_ver")
    ok = ver.isNotNull() & ((ver["effective_to"] == far_future())
                            | (F.col(at) < ver["effective_to"] + _span(unit)))
    ev_cols = [c for c in events.columns]
    out = got.select(*ev_cols, *[F.when(ok, ver[c]).alias(c) for c in payload],
                     F.when(ok, ver["vf"]).alias("effective_from"),
                     F.when(ok, ver["effective_to"]).alias("effective_to"),
                     F.when(ok, ver["delete_flg"]).alias("delete_flg"))
    if how == "inner":
        return out.where(F.col("effective_from").isNotNull())
    lost = events.where(~(_not_null(keys) & F.col(at).isNotNull()))   # no version, but the event stays
    return out.unionByName(lost, allowMissingColumns=True)


def scd2_check(hist: DataFrame, keys: list[str]) -> DataFrame:
    """Invariant violations per key: more than one open row, or overlapping versions.

    Empty result = consistent history. One window per key over its versions.
    """
    w = Window.partitionBy(*keys).orderBy("effective_from", "effective_to")
    x = hist.select(*keys, "effective_from", "effective_to",
                    F.lag("effective_to").over(w).alias("_pe"),
                    F.sum(F.when(is_open(), 1).otherwise(0)).over(Window.partitionBy(*keys)).alias("_open"))
    return (x.where((F.col("_open") != 1) | (F.col("_pe") >= F.col("effective_from")))
             .select(*keys, "effective_from", "effective_to", "_open").distinct())
