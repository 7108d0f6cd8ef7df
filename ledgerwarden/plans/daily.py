"""One daily run -- dimensions, facts and the cumulative report.

Inputs are DataFrames (a JDBC read of the source system, or files landed by
``sources.feeds``); outputs go to a ``Warehouse`` and become visible together
when the run's manifest is published.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerwarden.operators.facts import append_new
from ledgerwarden.operators.owner import owner_bridge
from ledgerwarden.operators.quarantine import judged_transactions, refused_changes, refused_keys
from ledgerwarden.operators.report import fraud_report
from ledgerwarden.operators.scd2 import scd2_cdc_delta, scd2_merge_log, scd2_snapshot_delta
from ledgerwarden.plans.incremental import append_index, in_days, report_scope
from ledgerwarden.plans.keyfilters import append_unseen, write_filter
from ledgerwarden.plans.state import DAY, LOADED, PART, Manifest, Warehouse, next_manifest, observed
from ledgerwarden.schemas import (
    BLACKLIST_FACT,
    DIMENSIONS,
    REPORT,
    TRANSACTIONS_FACT,
)
from ledgerwarden.sources.extract import extract_increment, live_keys, source_changes

CDC_SOURCES = {
    "cards": ["card_num", "account"],
    "accounts": ["account", "valid_to", "client"],
    "clients": ["client_id", "last_name", "first_name", "patronymic", "date_of_birth",
                "passport_num", "passport_valid_to", "phone"],
}


@dataclass
class DayFeeds:
    """What one run consumes. Source tables carry ``create_dt``/``update_dt``."""
    cards: DataFrame | None = None
    accounts: DataFrame | None = None
    clients: DataFrame | None = None
    terminals: DataFrame | None = None
    blacklist: DataFrame | None = None
    transactions: DataFrame | None = None           # typed; or
    transactions_raw: DataFrame | None = None       # as text columns: what cannot be typed is refused and kept
    files: list[str] = field(default_factory=list)
    dates: dict[str, dt.date] = field(default_factory=dict)     # business dates of files, where known


@dataclass
class RunOptions:
    cities_within: str = "1 hour"
    guessing_within: str = "20 minutes"
    rejects: int = 3
    owner_mode: str = "current"      # one owner per card; "as_of" = at the transaction's time; "all" = parity (Q6)
    terminal_mode: str = "current"
    unique_transactions: bool = False
    null_safe_report: bool = False   # Q8: a NULL passport is a key value
    distinct_report: bool = False    # Q7: drop exact duplicate candidates within a run
    incremental: bool | None = None  # rules over what this run can change only; None: where null_safe_report allows it
    quarantine: bool = True          # keep and count the rows of the other feeds that the merges leave out
    every_change: bool = False       # sources are change logs: each change of a key becomes a version

    def basis(self) -> str:
        """The options that decide which rows the report holds."""
        return "|".join(map(str, (self.cities_within, self.guessing_within, self.rejects, self.owner_mode,
                                  self.terminal_mode, self.null_safe_report, self.distinct_report)))


def _dim_rows(name: str, src: DataFrame) -> DataFrame:
    spec = DIMENSIONS[name]
    out = src
    for a, b in spec["rename"].items():
        out = out.withColumnRenamed(a, b)
    if "phone" in out.columns:
        out = out.withColumn("phone", F.rtrim("phone"))   # char(16) -> varchar
    return out


def run_day(wh: Warehouse, feeds: DayFeeds, run_ts: dt.datetime,
            options: RunOptions | None = None, advance: bool = True) -> Manifest:
    """Load one day and append its report rows; returns the published manifest.

    ``advance=False`` (late files of a day that has been run) leaves the report date where it is.

    Files that the ledger lists as consumed by an earlier run are refused (a
    file is loaded once even if the run before crashed after loading it).

    The incremental report gives the rows of the full rescan from the
    transactions this run can change (see ``plans.incremental``); the first
    run, and the one after the report's options changed, scan all. Rows that
    cannot be loaded are kept in ``Warehouse.rejected`` and counted in the
    manifest (``operators.quarantine``).
    """
    opt = options or RunOptions()
    if opt.incremental and not opt.null_safe_report:
        raise ValueError("incremental needs null_safe_report: parity reports NULL keys again in every run")
    incremental = opt.null_safe_report if opt.incremental is None else opt.incremental
    prev = wh.latest()
    if feeds.files:
        asked = wh.spark.createDataFrame([(f,) for f in feeds.files], "path string")
        again = sorted(r.path for r in wh.known_files(prev, asked).distinct().collect())       # of this run's files
        if again:
            raise ValueError(f"already consumed: {again}")
    m = next_manifest(prev, run_ts)

    for name, cols in CDC_SOURCES.items():
        src = getattr(feeds, name)
        if src is None:
            continue
        spec = DIMENSIONS[name]
        wm = dt.datetime.fromisoformat(prev.watermarks[name])
        opened, top = wh.open_rows(prev, name, spec["hist"]), F.max("mod_dt").alias("max_mod_dt")
        if opt.every_change:
            changes = _dim_rows(name, extract_increment(src, wm, cols))
            keys = _dim_rows(name, live_keys(src, [cols[0]]))
            latest = changes.agg(top).first()[0]        # not observed: the merge samples the changes in a job of its own
            delta = scd2_merge_log(opened, changes, spec["key"], spec["tracked"], "mod_dt", keys, run_ts)
            wh.write_history_delta(m, name, delta, refused_changes(src, [cols[0]], wm, name) if opt.quarantine else None)
        else:
            # One pass over the source gives changes, live keys and refused rows. D6 without an extra job:
            # max(mod_dt) is observed while the merge is written.
            seen = Observation(f"watermark_{name}")
            changes = _dim_rows(name, source_changes(src, [cols[0]], cols, wm, opt.quarantine)).observe(seen, top)
            delta = scd2_cdc_delta(opened, changes, spec["key"], spec["tracked"], "mod_dt", run_ts=run_ts, whole=True)
            wh.write_history_delta(m, name, delta)
            latest = observed(seen).get("max_mod_dt")
        new_wm = latest or wm
        m.watermarks[name] = new_wm.isoformat(sep=" ")

    if feeds.terminals is not None:
        spec = DIMENSIONS["terminals"]
        opened = wh.open_rows(prev, "terminals", spec["hist"])
        delta = scd2_snapshot_delta(opened, feeds.terminals, spec["key"], spec["tracked"], run_ts)
        refused = refused_keys(feeds.terminals, spec["key"], "terminals") if opt.quarantine else None
        wh.write_history_delta(m, "terminals", delta, refused)

    if feeds.blacklist is not None:
        known = wh.fact(prev, "blacklist", BLACKLIST_FACT)
        fresh = append_new(known, feeds.blacklist).select(*BLACKLIST_FACT.fieldNames())
        wh.append_fact(m, "blacklist", fresh,
                       refused_keys(feeds.blacklist, ["passport_num"], "blacklist") if opt.quarantine else None)

    tx = _transactions(feeds)
    if tx is not None:
        if opt.unique_transactions:
            loaded = tx if PART not in tx.columns else tx.where(F.col(PART) == LOADED)
            unseen = append_unseen(wh, prev, "transactions", TRANSACTIONS_FACT, loaded)
            tx = unseen if PART not in tx.columns else unseen.unionByName(tx.where(F.col(PART) != LOADED))
        wh.append_fact(m, "transactions", tx)
        if opt.unique_transactions:
            write_filter(wh, m, "transactions", TRANSACTIONS_FACT)
    if not prev.indexed:                # written before there was a day index
        append_index(wh, m, wh.fact(m, "transactions", TRANSACTIONS_FACT))
        m.indexed = True
    else:
        added = wh.added(prev, m, "transactions", TRANSACTIONS_FACT)
        if added is not None:
            append_index(wh, m, added)

    # The report reads what this run wrote (new directories, nothing overwritten).
    hist = {n: wh.history(m, n, DIMENSIONS[n]["hist"]) for n in ("cards", "accounts", "clients", "terminals")}
    bridge = owner_bridge(hist["cards"], hist["accounts"], hist["clients"],
                          wh.fact(m, "blacklist", BLACKLIST_FACT), mode=opt.owner_mode)
    report_dt = dt.date.fromisoformat(m.report_date)
    if incremental and prev.report_basis == opt.basis():
        tx, days = report_scope(wh, prev, m, [opt.cities_within, opt.guessing_within])
        prior = wh.fact(prev, "report", REPORT, where=in_days(DAY, days))       # candidates lie in these days only
    else:
        tx, prior = wh.fact(m, "transactions", TRANSACTIONS_FACT), wh.fact(prev, "report", REPORT)
    rows = fraud_report(tx, hist["terminals"], bridge, prior=prior, report_dt=report_dt,
                        cities_within=opt.cities_within, guessing_within=opt.guessing_within,
                        rejects=opt.rejects, terminal_mode=opt.terminal_mode,
                        null_safe=opt.null_safe_report, distinct=opt.distinct_report)
    m.report_basis = opt.basis()
    wh.append_fact(m, "report", rows)
    if advance:
        m.report_date = (report_dt + dt.timedelta(days=1)).isoformat()
    wh.settle_files(m, [(f, feeds.dates.get(f)) for f in feeds.files])
    wh.settle_counts(m)
    wh.publish(m)
    return m


def _transactions(feeds: DayFeeds) -> DataFrame | None:
    """The transactions to append; of a raw feed with its refused rows, marked."""
    if feeds.transactions_raw is not None:
        if feeds.transactions is not None:
            raise ValueError("transactions come typed or raw, not both")
        return judged_transactions(feeds.transactions_raw)
    if feeds.transactions is None:
        return None
    return feeds.transactions.select(*[F.col(f.name).cast(f.dataType) for f in TRANSACTIONS_FACT.fields])
