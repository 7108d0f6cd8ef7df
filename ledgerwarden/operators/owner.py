"""Owner bridge: card -> account -> client (+ first blacklist date of the passport).

The reference repeats this three-table chain inside each of its four rules;
here it is built once and joined to transactions by card number. Card numbers
are trimmed on both sides (the reference compares ``trim(x) = trim(y)``), so
the join stays a plain equi-join on a column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwarden.functions.columns import full_name
from ledgerwarden.operators.sizing import broadcast_if_small
from ledgerwarden.operators.versions import resolve, validity

BRIDGE_COLUMNS = ["card_num", "account_num", "valid_to", "client_id", "passport",
                  "passport_valid_to", "fio", "phone", "blacklisted_from"]


def blacklist_first_entry(blacklist: DataFrame) -> DataFrame:
    """``passport_num -> min(entry_dt)``: ``t >= min(entry_dt)`` is the reference's
    ``passport in (select ... where t >= entry_dt)`` without fan-out."""
    return (blacklist.where(F.col("passport_num").isNotNull())
            .groupBy("passport_num").agg(F.min("entry_dt").alias("blacklisted_from")))


def owner_bridge(cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                 blacklist: DataFrame | None = None, mode: str = "all") -> DataFrame:
    """One row per (card version, account version, client version) chain.

    ``mode`` is passed to ``resolve`` for each history: ``all`` reproduces the
    reference (every version joins, Q6), ``current`` gives one owner per card,
    ``as_of`` returns an ``OwnerAsOf`` that resolves owners at transaction time.
    """
    if mode == "as_of":
        return OwnerAsOf(cards, accounts, clients, blacklist)
    c = resolve(cards, mode).select(F.trim("card_num").alias("card_num"), "account_num")
    a = resolve(accounts, mode).select("account_num", "valid_to", "client")
    cl = resolve(clients, mode).select(
        "client_id", F.col("passport_num").alias("passport"), "passport_valid_to",
        full_name("last_name", "first_name", "patronymic").alias("fio"), "phone")
    bridge = (c.join(a, "account_num")
               .join(cl, F.col("client") == F.col("client_id"))
               .drop("client"))
    if blacklist is not None:
        bl = blacklist_first_entry(blacklist)
        bridge = (bridge.join(bl, F.col("passport") == F.col("passport_num"), "left")
                        .drop("passport_num"))
    else:
        bridge = bridge.withColumn("blacklisted_from", F.lit(None).cast("date"))
    return bridge.select(*BRIDGE_COLUMNS)


#: Up to this many versions of a key are tested one by one; a version array holds at most CHUNK of them.
FEW_VERSIONS, CHUNK = 16, 256


def version_at(events: DataFrame, versions: DataFrame, key: str, t: str, payload: list[str]) -> DataFrame:
    """Events joined to the version of ``key`` valid at ``events[t]`` (inner).

    A key's versions do not overlap, so an event meets one at most. Where no
    key has more than ``FEW_VERSIONS`` (one aggregate over the versions tells), this is an equi-join on the key
    with the validity test as its residual condition. Else the versions are
    sorted into arrays of at most ``CHUNK``; an event meets one array by an
    equi-join and finds its version there by binary search, so a key with
    thousands of versions costs an event some ten tests. Keys with several
    arrays have a directory of the arrays' first times, which an event searches
    first; it is broadcast where its measured size allows, so the events move
    once, and a hot key's are split by AQE's skew join.
    """
    v = versions.where(F.col(key).isNotNull() & F.col("_valid_from").isNotNull() & (F.col("_valid_from") < F.col("_valid_until")))
    most = v.groupBy(key).count().agg(F.max("count")).first()[0] or 0
    if most <= FEW_VERSIONS:
        v = versions.select(F.col(key).alias("_vk"), "_valid_from", "_valid_until",
                            *[F.col(c).alias(f"_v_{c}") for c in payload])
        hit = ((events[key] == F.col("_vk")) & (F.col("_valid_from") <= events[t])
               & (events[t] < F.col("_valid_until")))
        return events.join(v, hit).select(*[events[c] for c in events.columns],
                                          *[F.col(f"_v_{c}").alias(c) for c in payload])
    return _searched(events, v, key, t, payload, most)


def _searched(events: DataFrame, v: DataFrame, key: str, t: str, payload: list[str], most: int) -> DataFrame:
    row = F.struct(F.col("_valid_from").alias("f"), F.col("_valid_until").alias("u"), *[F.col(c).alias(f"_v_{c}") for c in payload])
    e = events.select(*[events[c] for c in events.columns])
    if most <= CHUNK:
        arrays = v.groupBy(F.col(key).alias("_vk")).agg(F.sort_array(F.collect_list(row)).alias("_va"))
        met = e.join(arrays, F.col(key) == F.col("_vk"))
    else:
        order = Window.partitionBy(key).orderBy("_valid_from", "_valid_until")
        numbered = v.withColumn("_vc", ((F.row_number().over(order) - 1) / F.lit(CHUNK)).cast("int"))
        arrays = (numbered.groupBy(F.col(key).alias("_vk"), "_vc")
                  .agg(F.sort_array(F.collect_list(row)).alias("_va"), F.min("_valid_from").alias("_vf")))
        several = (arrays.where("_vc > 0").select("_vk", F.struct(F.col("_vf").alias("f")).alias("s"))      # the first needs no entry
                   .groupBy(F.col("_vk").alias("_dk")).agg(F.sort_array(F.collect_list("s")).alias("_dir")))
        e = e.join(broadcast_if_small(several), F.col(key) == F.col("_dk"), "left")
        e = e.withColumn("_ec", F.expr(f"CASE WHEN _dir IS NULL THEN 0 ELSE {_upto('_dir', t)} END"))
        met = e.join(arrays, (F.col(key) == F.col("_vk")) & (F.col("_ec") == F.col("_vc")))
    found = met.withColumn("_n", F.expr(_upto("_va", t))).withColumn("_v", F.expr("CASE WHEN _n > 0 THEN _va[_n - 1] END"))
    return found.where(F.col(t) < F.col("_v.u")).select(
        *[F.col(c) for c in events.columns], *[F.col(f"_v._v_{c}").alias(c) for c in payload])


def _upto(array: str, t: str) -> str:
    """SQL: how many entries of the array, sorted by ``f``, have f <= t (binary search)."""
    mid = "((a.lo + a.hi) div 2)"
    pair = "named_struct('lo', {}, 'hi', {})"
    step = (f"CASE WHEN a.lo >= a.hi THEN a WHEN {array}[CAST({mid} AS INT)].f <= `{t}` "
            f"THEN {pair.format(f'CAST({mid} + 1 AS INT)', 'a.hi')} ELSE {pair.format('a.lo', f'CAST({mid} AS INT)')} END")
    return (f"aggregate(sequence(1, CAST(ceil(log2(size({array}) + 1)) AS INT)), {pair.format('0', f'size({array})')}, "
            f"(a, i) -> {step}, a -> a.lo)")


class OwnerAsOf:
    """Owner chain resolved at each transaction's time (``mode='as_of'``).

    Three lookups (``version_at``) -- card version, then its account's version,
    then the client's version valid at ``trans_date`` -- each one shuffle of
    the transactions by the key, or none where the dimension is small enough
    for Catalyst or AQE to broadcast it; versions of one key are never paired
    with each other, and keys with many are searched, not scanned.
    """

    def __init__(self, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                 blacklist: DataFrame | None = None, unit="1 second", extend_first: bool = False):
        self.cards = validity(cards.withColumn("card_num", F.trim("card_num")), ["card_num"], unit,
                              extend_first).select("card_num", "_valid_from", "_valid_until", "account_num")
        self.accounts = validity(accounts, ["account_num"], unit, extend_first).select(
            "account_num", "_valid_from", "_valid_until", "valid_to", F.col("client").alias("client_id"))
        self.clients = validity(clients, ["client_id"], unit, extend_first).select(
            "client_id", "_valid_from", "_valid_until", F.col("passport_num").alias("passport"),
            "passport_valid_to", full_name("last_name", "first_name", "patronymic").alias("fio"), "phone")
        self.blacklist = blacklist_first_entry(blacklist) if blacklist is not None else None

    def attach(self, events: DataFrame, t: str = "trans_date") -> DataFrame:
        """``events`` (with ``card_num`` and ``t``) plus the owner columns of BRIDGE_COLUMNS."""
        x = version_at(events, self.cards, "card_num", t, ["account_num"])
        x = version_at(x, self.accounts, "account_num", t, ["valid_to", "client_id"])
        x = version_at(x, self.clients, "client_id", t, ["passport", "passport_valid_to", "fio", "phone"])
        if self.blacklist is not None:
            x = x.join(self.blacklist, F.col("passport") == F.col("passport_num"), "left").drop("passport_num")
        else:
            x = x.withColumn("blacklisted_from", F.lit(None).cast("date"))
        return x


def attach_owner(events: DataFrame, bridge, t: str = "trans_date") -> DataFrame:
    """Join events to owners: an equi-join on the card for a bridge DataFrame
    (modes all/current), an as-of lookup for ``OwnerAsOf``."""
    if isinstance(bridge, OwnerAsOf):
        return bridge.attach(events, t)
    return events.join(bridge, "card_num")
