"""Operator 4: mixing sources to target weights by Sainte-Lague apportionment.

Targets: the sources, ordered by code point with null last, weigh 5, 2, 1 in
turn and share the corpus's words; a target stops at ``max_repeat`` times its
source's size, and what is over goes to the others by weight until none is
above. Quotas: the mix is ``blocks`` of equal words, given one by one to the
source with the highest quotient target / (2 * blocks so far + 1); a source's
blocks are given to its shards (documents by a seeded hash) in the same way by
shard size. The result of giving blocks one by one is found by bisection on
the last quotient. Selection: the words of a shard, its documents in seeded
order, form a row of blocks; the quota takes every block as often as it goes
and picks the rest of the blocks evenly from a seeded start. A shard's last block
may be a short one, so that every word is in some block.

All is DataFrame work on (source, size, order) except the apportionment, which
is on the driver over one row for each source and each shard; shards number
at most ``MAX_SHARDS`` plus one for each source.

Rows and ties. Size: words of the text (null: 0). Rows without words are never
taken (0 words). The seeded place is a hash of doc_id and text; documents of
equal place are ordered by doc_id, size and text. An empty table, or one without words, gives targets 0. Other columns
pass through ``mix_documents`` untouched.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = 20
#: Words of a shard at least; with more words than MAX_SHARDS of these, shards grow.
SHARD_WORDS = 1 << 14
MAX_SHARDS = 1 << 16
#: A block has at most this many words, and a hundredth of the smallest target.
BLOCK_WORDS = 256

WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: list[float], max_repeat: int = MAX_REPEAT) -> np.ndarray:
    """Shares of the total by weight, none above max_repeat times its size; the excess is reshared."""
    size, weight = np.array(sizes, float), np.array(weights, float)
    cap, goal = size * max_repeat, np.zeros(len(size))
    full = cap <= 0
    goal[full] = 0
    while not full.all():
        rest = size.sum() - goal[full].sum()
        share = rest * weight / weight[~full].sum()
        over = ~full & (share > cap)
        if not over.any():
            goal[~full] = share[~full]
            break
        goal[over] = cap[over]
        full |= over
    return goal


def sainte_lague(shares: np.ndarray, seats: int) -> np.ndarray:
    """Seats by highest quotients share / (2k + 1); equal quotients go to the lower index."""
    share = np.asarray(shares, float)
    got = np.zeros(len(share), np.int64)
    if seats <= 0 or not (share > 0).any():
        return got
    count = lambda level: np.floor((share / level + 1) / 2).astype(np.int64)  # noqa: E731  quotients >= level
    low, high = 0.0, float(share.max()) * 2
    level = share.sum() / (2 * seats + len(share) + 1)
    low = min(level, high) / 2
    while count(low).sum() < seats:
        low /= 2
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        low, high = (mid, high) if count(mid).sum() >= seats else (low, mid)
    # rounding may count a quotient that equals the level for one share and not for another: step back
    # one seat each and give the rest by the quotients themselves
    got = np.maximum(count(high) - 1, 0)
    heap = [(-share[i] / (2 * got[i] + 1), i) for i in range(len(share))]
    heapq.heapify(heap)
    for _ in range(seats - int(got.sum())):
        i = heap[0][1]
        got[i] += 1
        heapq.heapreplace(heap, (-share[i] / (2 * got[i] + 1), i))
    return got


def sized(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The columns ``carry`` of ``docs`` with __lw_id, __lw_source, __lw_size and __lw_tie of every row."""
    return docs.select(*[F.col(c) for c in carry], F.col("doc_id").cast("long").alias("__lw_id"),
                       F.col("source").alias("__lw_source"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("__lw_size"),
                       F.xxhash64("text").alias("__lw_tie"))


class Quotas:
    """What the apportionment gives: a row for each source, a row for each shard, the block size."""

    def __init__(self, sources: list[tuple], shards: list[tuple], block: int):
        self.sources, self.shards, self.block = sources, shards, block


def _sharded(rows: DataFrame, sources: list[tuple]) -> DataFrame:
    head = rows.sparkSession.createDataFrame(
        sources, "__lw_src string, __lw_source_size long, __lw_target double, __lw_shards int")
    place = F.xxhash64("__lw_id", "__lw_tie", F.lit(SEED))        # rows without an id are dealt out by their texts
    head = F.broadcast(head) if len(sources) <= 2 * MAX_SHARDS else head
    return (rows.join(head, F.col("__lw_source").eqNullSafe(F.col("__lw_src"))).drop("__lw_src")  # a row for each source
            .withColumn("__lw_place", place)
            .withColumn("__lw_shard", F.expr("CAST(pmod(__lw_place >> 7, __lw_shards) AS INT)")))


def quotas(rows: DataFrame, weights: tuple = WEIGHTS, max_repeat: int = MAX_REPEAT) -> Quotas:
    """Apportion blocks to the sources and shards of ``rows`` (see ``sized``), two aggregates over them."""
    per_source = rows.groupBy("__lw_source").agg(F.sum("__lw_size").alias("words")).collect()
    ordered = sorted(per_source, key=lambda r: (r["__lw_source"] is None, r["__lw_source"] or ""))
    sizes = [int(r["words"]) for r in ordered]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], max_repeat)
    total = sum(sizes)
    wanted = [g for g in goal if g > 0]
    block = int(max(1, min(BLOCK_WORDS, min(wanted) // 100))) if wanted else 1
    shard_words = max(SHARD_WORDS, -(-total // MAX_SHARDS))
    sources = [(r["__lw_source"], s, float(g), max(1, -(-s // shard_words))) for r, s, g in zip(ordered, sizes, goal)]
    if not sources:
        return Quotas([], [], block)
    per_shard: dict = {}
    counted = _sharded(rows, sources).groupBy("__lw_source", "__lw_shard").agg(F.sum("__lw_size").alias("words"))
    for r in counted.collect():
        per_shard.setdefault(r["__lw_source"], []).append((r["__lw_shard"], int(r["words"])))
    seats = sainte_lague(goal, round(goal.sum() / block))
    shards = []
    for (source, *_), n in zip(sources, seats.tolist()):
        own = sorted(per_shard.get(source, []))
        for (shard, w), q in zip(own, sainte_lague(np.array([w for _, w in own]), n).tolist()):
            passes = min(max_repeat, q * block // w) if w else 0
            blocks = -(-w // block)                             # the last may be a short one
            start = (shard * 2654435761 + SEED * 40503) % max(1, blocks)
            m = _nearest(q * block - passes * w, w, block, blocks, start) if passes < max_repeat else 0
            shards.append((source, shard, passes, blocks, m, start))
    return Quotas(sources, shards, block)


def _nearest(want: int, w: int, block: int, blocks: int, start: int) -> int:
    """How many blocks to pick so that their words come nearest to ``want``, the last block having what is left of ``w``."""
    def words(m):
        last = blocks and (blocks * m + start) // blocks > ((blocks - 1) * m + start) // blocks
        return m * block - (blocks * block - w if last else 0)

    least = min(max(want // block, 0), blocks)
    return min((m for m in (least, least + 1) if m <= blocks), key=lambda m: (abs(words(m) - want), m))


def placed(rows: DataFrame, q: Quotas) -> DataFrame:
    """``rows`` (see ``sized``) with __lw_source_size, __lw_target, __lw_passes, __lw_taken and the place in the shard.

    One shuffle, by (source, shard).
    """
    spark = rows.sparkSession
    given = spark.createDataFrame(
        q.shards, "__lw_src string, __lw_given int, __lw_passes int, __lw_blocks long, __lw_m long, __lw_s long")
    given = F.broadcast(given) if len(q.shards) <= 2 * MAX_SHARDS else given
    known = _sharded(rows, q.sources).join(
        given, F.col("__lw_source").eqNullSafe(F.col("__lw_src")) & (F.col("__lw_shard") == F.col("__lw_given"))).drop("__lw_src", "__lw_given")
    upto = ("sum(__lw_size) OVER (PARTITION BY __lw_source, __lw_shard "
            "ORDER BY __lw_place, __lw_id, __lw_size, __lw_tie ROWS UNBOUNDED PRECEDING)")
    out = (known.withColumn("__lw_b", F.lit(q.block).cast("long")).withColumn("__lw_at", F.expr(f"{upto} - __lw_size"))
           .withColumn("__lw_nb", F.expr("greatest(__lw_blocks, 1L)")))
    for name, x in (("from", "__lw_at"), ("to", "(__lw_at + __lw_size)")):   # words picked before a place of the shard
        out = (out.withColumn("__lw_j", F.expr(f"least({x} div __lw_b, __lw_blocks)"))
               .withColumn("__lw_p", F.expr("(__lw_j * __lw_m + __lw_s) div __lw_nb"))
               .withColumn(f"__lw_{name}", F.expr(
                   "__lw_b * __lw_p + IF(__lw_j < __lw_blocks AND ((__lw_j + 1) * __lw_m + __lw_s) div __lw_nb > __lw_p, "
                   f"{x} % __lw_b, 0)")))
    return (out.withColumn("__lw_extra", F.expr("__lw_to - __lw_from"))
            .withColumn("__lw_taken", F.expr("__lw_passes * __lw_size + __lw_extra"))
            .drop("__lw_place", "__lw_shards", "__lw_tie", "__lw_j", "__lw_p", "__lw_from", "__lw_to"))


def _spans(text: str, at: int, size: int, b: int, blocks: int, nb: int, m: int, s: int) -> str:
    """The picked words of a text whose words have places at..at+size-1 in the shard; runs apart by a line end."""
    word = np.arange(at, at + size)
    j = word // b
    chosen = (j < blocks) & (((j + 1) * m + s) // nb > (j * m + s) // nb)
    if chosen.all():
        return text
    spots = [x.span() for x in re.finditer(WORD, text)]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], chosen.astype(np.int8), [0]])))
    return "\n".join(text[spots[a][0]:spots[e - 1][1]] for a, e in zip(edges[::2].tolist(), edges[1::2].tolist()))


def _emit(names: list[str]):
    plan = ["__lw_passes", "__lw_extra", "__lw_at", "__lw_size", "__lw_b", "__lw_blocks", "__lw_nb", "__lw_m", "__lw_s"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = part.column("text").to_pylist()
                rows, out = [], []
                for i, (passes, extra, *spot) in enumerate(zip(*[part.column(c).to_pylist() for c in plan])):
                    rows += [i] * passes
                    out += [texts[i]] * passes
                    if extra:
                        rows.append(i)
                        out.append(_spans(texts[i], *spot))
                got = part.take(pa.array(rows, pa.int64()))
                cols = []
                for f in names:
                    c = got.column(f)
                    cols.append(pa.array(out, c.type) if f == "text" else
                                pa.array([len(t) for t in out], c.type) if f == "n_chars" else c)
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


def mix_documents(docs: DataFrame, weights: tuple = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """The mix itself, with the columns of ``docs``: whole copies, and the picked words of the partial pass.

    n_chars, where there is such a column, is that of the text given out.
    """
    ship(docs.sparkSession)
    q = quotas(sized(docs, []), weights, max_repeat)
    if not q.shards:
        return docs.limit(0)
    names = docs.columns
    taken = placed(sized(docs, names), q).where("__lw_taken > 0")
    return taken.mapInArrow(_emit(names), docs.schema)
