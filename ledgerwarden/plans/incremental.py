"""What a run's report has to look at: the transactions whose candidates may differ from the last run's.

A candidate depends on one transaction (rules 1-2) or on neighbours within a
span (rules 3-4), on the versions its owner chain goes through, on the
passport's blacklist entry, and for rule 3 on terminals. A candidate that held
at the last run is in the report already, so a new one has an input of this
run: a loaded transaction, or a changed version. ``report_scope`` returns

* every transaction of the days within the rules' span of a loaded one (late
  transactions included), read by partition, and
* of cards whose owner chain changed, the days on which they have
  transactions; of cards with transactions at a changed terminal, the days
  within the rules' span of those.

Which days these are is looked up in the day index, a table of
(terminal, card, day) and (card, day) rows that every load appends to,
partitioned by kind and a hash bucket of the looked-up key. So both the index
and the transactions are read by partition.

The rules over this scope find every candidate of the full rescan that is not
in the report. Gaps between its days are longer than the span, so rows
on the two sides of a gap are never taken for neighbours.
"""

from __future__ import annotations

import datetime as dt
import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwarden.functions.columns import interval_seconds
from ledgerwarden.plans.state import DAY, Manifest, Warehouse
from ledgerwarden.schemas import BLACKLIST_FACT, DIMENSIONS, TRANSACTIONS_FACT

Days = list[tuple[dt.date, dt.date]]


def day_ranges(days: list[dt.date], reach: int) -> Days:
    """Ranges (first, last) of the days within ``reach`` of ``days``; gaps of ``reach`` days or fewer are closed."""
    pad, out = dt.timedelta(days=reach), []
    for day in sorted(set(days)):
        first = day - pad if day - dt.date.min >= pad else dt.date.min
        last = day + pad if dt.date.max - day >= pad else dt.date.max
        if out and (first - out[-1][1]).days <= reach + 1:
            out[-1] = (out[-1][0], last)
        else:
            out.append((first, last))
    return out


def reach_days(*spans: str) -> int:
    """Calendar days that two events within the longest span can lie apart."""
    return max(1, *[math.ceil(interval_seconds(s) / 86400) for s in spans])


def in_days(column: str, ranges: Days) -> Column:
    """``column`` (a date) lies in one of the ranges."""
    tests = [F.col(column).between(F.lit(a), F.lit(b)) for a, b in ranges]
    return reduce(lambda x, y: x | y, tests, F.lit(False))


def changed_keys(wh: Warehouse, prev: Manifest, m: Manifest, name: str) -> DataFrame | None:
    """Keys of a dimension with a version that this run closed, opened or altered; None where it did not touch it.

    Reads the run's own closed folder and both open parts, never the closed history.
    """
    now, before = m.tables.get(name, {}), prev.tables.get(name, {})
    if now == before:
        return None
    spec = DIMENSIONS[name]
    closed = wh._read([p for p in now.get("closed", []) if p not in before.get("closed", [])], spec["hist"])
    opened = wh.open_rows(m, name, spec["hist"]).subtract(wh.open_rows(prev, name, spec["hist"]))
    return closed.unionByName(opened).select(*spec["key"]).distinct()


def _together(parts: list[DataFrame | None]) -> DataFrame | None:
    known = [p for p in parts if p is not None]
    return reduce(DataFrame.unionAll, known) if known else None


INDEX, INDEX_BUCKETS = "card_days", 16
_INDEX_SCHEMA = "key string, card_num string, day date, run string, kind string, bucket int"


def _bucket(key) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(INDEX_BUCKETS)).cast("int")


def index_rows(tx: DataFrame) -> DataFrame:
    """Rows of the day index for transactions: kind ``terminal`` and ``card``, the key looked up, the card, the day."""
    card = F.trim("card_num")
    told = tx.select(card.alias("card_num"), F.to_date("trans_date").alias("day"), F.explode(F.array(
        F.struct(F.lit("card").alias("kind"), card.alias("key")),
        F.struct(F.lit("terminal").alias("kind"), F.col("terminal").alias("key")))).alias("x"))
    return (told.select("x.key", "card_num", "day", "x.kind").where("key IS NOT NULL AND card_num IS NOT NULL AND day IS NOT NULL")
            .distinct().withColumn("bucket", _bucket("key")))


def append_index(wh: Warehouse, m: Manifest, tx: DataFrame) -> None:
    path = f"{wh.root}/{INDEX}/{m.folder()}"
    index_rows(tx).hint("rebalance", "kind", "bucket").write.partitionBy("kind", "bucket").parquet(path)
    t = m.tables.setdefault(INDEX, {"parts": []})
    t["parts"] = t.get("parts", []) + [path]


def indexed_days(wh: Warehouse, m: Manifest, kind: str, keys: DataFrame) -> DataFrame:
    """(card_num, day) of the index for ``keys`` (a column key); reads the buckets of these keys only."""
    parts = m.tables.get(INDEX, {}).get("parts", [])
    if not parts:
        return wh.spark.createDataFrame([], "card_num string, day date")
    buckets = [r.b for r in keys.select(_bucket("key").alias("b")).distinct().collect()]        # INDEX_BUCKETS at most
    rows = wh.spark.read.schema(_INDEX_SCHEMA).option("basePath", f"{wh.root}/{INDEX}").parquet(*parts)
    rows = rows.where((F.col("kind") == kind) & F.col("bucket").isin(buckets))
    return rows.join(keys.select("key"), "key", "left_semi").select("card_num", "day")


def owner_cards(wh: Warehouse, prev: Manifest, m: Manifest) -> DataFrame | None:
    """``key``: card numbers (trimmed) whose owner chain or blacklist entry this run changed.

    The chain goes through all versions, so it covers every owner mode. None
    where the run changed no owner dimension and no blacklist entry.
    """
    cards, accounts, clients = (wh.history(m, n, DIMENSIONS[n]["hist"]) for n in ("cards", "accounts", "clients"))
    c = changed_keys(wh, prev, m, "clients")
    listed = wh.added(prev, m, "blacklist", BLACKLIST_FACT)
    if listed is not None:
        by_passport = clients.join(listed.select("passport_num").distinct(), "passport_num", "left_semi")
        c = _together([c, by_passport.select("client_id")])
    a = changed_keys(wh, prev, m, "accounts")
    if c is not None:
        a = _together([a, accounts.join(c, F.col("client") == c["client_id"], "left_semi").select("account_num")])
    k = changed_keys(wh, prev, m, "cards")
    if a is not None:
        k = _together([k, cards.join(a, "account_num", "left_semi").select("card_num")])
    return None if k is None else k.select(F.trim("card_num").alias("key")).where("key IS NOT NULL").distinct()


def report_scope(wh: Warehouse, prev: Manifest, m: Manifest, spans: list[str]) -> tuple[DataFrame, Days]:
    """(transactions to run the rules over, the ranges of days they lie in)."""
    reach = reach_days(*spans)
    loaded = wh.added_days(prev, m, "transactions")
    ranges = day_ranges(loaded, reach)
    near = wh.fact(m, "transactions", TRANSACTIONS_FACT, where=in_days(DAY, ranges))
    owners, found = owner_cards(wh, prev, m), []
    if owners is not None:
        found.append(indexed_days(wh, m, "card", owners))
    places = changed_keys(wh, prev, m, "terminals")
    if places is not None:
        found.append(indexed_days(wh, m, "terminal", places.select(F.col("terminal_id").alias("key"))))
    pairs = _together(found)
    days = [] if pairs is None else [r.day for r in pairs.select("day").distinct().collect()]      # days of the calendar
    if not days:
        return near, ranges
    every = day_ranges([*loaded, *days], reach)
    far = wh.fact(m, "transactions", TRANSACTIONS_FACT, where=in_days(DAY, every) & ~in_days(DAY, ranges))
    cards = pairs.select(F.col("card_num").alias("_card")).distinct()
    return near.unionByName(far.join(cards, F.trim("card_num") == F.col("_card"), "left_semi")), every
