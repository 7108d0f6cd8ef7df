"""Conversation prefix trie: adaptive radix trees over fixed-width big-endian turn ids.

A turn's id has ``WIDTH`` bytes: 16 of a digest of role and text, then the
words of the text as a big-endian number; a conversation's key is the ids of
its turns. Keys are dealt by range, so that the copies of one conversation,
and conversations with one opening, spread over tasks; each task builds the
tree of its range (``radix_tree``) and walks it. Byte depths that are
whole turns are nodes; the bytes between are layout alone.

A node that only one range holds is final. The nodes on the way to a range's
first and last key may go on in the neighbours: they leave as one row for
each of the two keys, with what this range adds at each depth, and the same
walk over those rows (``SHARD`` of them at a time, level by level) finishes
them. Identical conversations are met in runs of ids, so the digest of a
node's ends is taken in order, in one task, from some thousandth of the rows.

Odd input: conversations without turns end at the root; turns of a
conversation with the same number are ordered by role and text, repeated
rows count as turns; null role or text is empty; rows without a conv_id
belong to no conversation and are left out; an empty table has no nodes.
Columns besides conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stage
from .radix_tree import Node, insert

#: Bytes of a turn id, of them the word count's.
WIDTH, COUNT = 20, 4
#: Rows a task's tree is built from, bytes of their keys, conversation ids in one run, hub rows that may be broadcast.
SHARD, SHARD_BYTES, RUN, SMALL = 4096, 8 << 20, 1024, 500_000

_WORD = r"[^\x20\x09-\x0D]+"
_EMPTY = hashlib.sha256(b"").hexdigest()
_NUMBERS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
_SCHEMA = (", ".join(f"{c} long" for c in _NUMBERS) + ", ends_sha256 string, node binary, parent_node binary, key binary, "
           "adds array<struct<depth: long, n: long, low: long, children: long, leaves: long, saved: long, ends: string>>")
_ADDS = pa.list_(pa.struct([(k, pa.int64()) for k in ("depth", "n", "low", "children", "leaves", "saved")] + [("ends", pa.string())]))


# --- conversations as keys ---------------------------------------------------------

def turn_id(role: str = "role", text: str = "text"):
    """The hex digits of a turn's id, from columns without nulls."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.substring(F.sha2(whole, 256), 1, 2 * (WIDTH - COUNT)),
                    F.lpad(F.hex(F.regexp_count(F.col(text), F.lit(_WORD)).cast("long")), 2 * COUNT, "0"))


def with_openings(rows: DataFrame, family: int = 20, most: int = 3) -> DataFrame:
    """(conv_id, key) of every conversation, its first h turns taken from the conversation that opens its family.

    c's family is c - c % ``family`` (the sign of c, as in SQL); h is the unsigned
    crc32 of c as text modulo ``most`` + 1. One shuffle, by family.
    """
    told = rows.where("conv_id IS NOT NULL").select(
        F.expr(f"CAST(conv_id AS LONG) - CAST(conv_id AS LONG) % {family}").alias("opener"),
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    turns = (told.withColumn("id", turn_id()).repartition("opener").groupBy("opener", "conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "id"))).alias("t"))      # one conversation
             .select("opener", "conv_id", F.expr("transform(t, x -> x.id)").alias("own")))
    opening = F.max(F.expr(f"CASE WHEN conv_id = opener THEN slice(own, 1, {most}) END")).over(Window.partitionBy("opener"))
    h = f"CAST(crc32(CAST(CAST(conv_id AS STRING) AS BINARY)) % {most + 1} AS INT)"
    return (turns.withColumn("opening", F.coalesce(opening, F.array().cast("array<string>"))).withColumn("h", F.expr(h))
            .select("conv_id", F.expr("unhex(array_join(concat(slice(opening, 1, h), slice(own, h + 1, size(own))), ''))").alias("key")))


# --- runs of equal keys --------------------------------------------------------------

def _runs(batches):
    """(key, first, n, ids): up to RUN ascending ids of one key, as comma-joined decimals."""
    key, ids, out = None, [], []
    for batch in batches:
        for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if k != key or len(ids) == RUN:
                if ids:
                    out.append((key, ids))
                key, ids = k, []
            ids.append(c)
        if len(out) > RUN:
            yield _run_rows(out)
            out = []
    if ids:
        out.append((key, ids))
    yield _run_rows(out)


def _run_rows(runs) -> pa.RecordBatch:
    return pa.record_batch([pa.array([k for k, _ in runs], pa.binary()), pa.array([i[0] for _, i in runs], pa.int64()),
                            pa.array([len(i) for _, i in runs], pa.int64()),
                            pa.array([",".join(map(str, i)) for _, i in runs], pa.string())], names=["key", "first", "n", "ids"])


# --- one range's tree ------------------------------------------------------------------

class Entry:
    """A key of the range, and what it adds to the nodes on its way: depth -> [n, low, children, leaves, saved, ends]."""
    __slots__ = ("key", "adds", "least", "_names")

    def __init__(self, key: bytes, adds: dict):
        self.key, self.adds, self.least, self._names = key, adds, min(adds), None

    def merge(self, adds: dict) -> None:
        for depth, more in adds.items():
            self.adds[depth] = _sum(self.adds.get(depth), more)
        self.least = min(self.least, min(adds))

    def names(self) -> list[bytes]:
        """The name of the node at every depth of the key, each from the one above."""
        if self._names is None:
            name, self._names = b"", [b""]
            for at in range(0, len(self.key), WIDTH):
                name = hashlib.blake2b(name + self.key[at:at + WIDTH], digest_size=16).digest()
                self._names.append(name)
        return self._names


def _sum(a, b):
    if a is None:
        return list(b)
    lows = [x for x in (a[1], b[1]) if x is not None]
    return [a[0] + b[0], min(lows) if lows else None, a[2] + b[2], a[3] + b[3], a[4] + b[4], a[5] or b[5]]


class Below:
    """What a walk brings up to the next whole-turn depth."""
    __slots__ = ("n", "low", "children", "leaves", "saved", "tops", "first", "last", "through")

    def __init__(self):
        self.n, self.low, self.children, self.leaves, self.saved = 0, None, 0, 0, 0
        self.tops, self.first, self.last, self.through = [], False, False, []

    def take(self, other: Below) -> None:
        self.n += other.n
        if other.low is not None and (self.low is None or other.low < self.low):
            self.low = other.low
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        if len(other.tops) > len(self.tops):
            self.tops, other.tops = other.tops, self.tops
        self.tops.extend(other.tops)
        self.first |= other.first
        self.last |= other.last
        self.through.extend(other.through)


class Walk:
    """The rows of one range: final nodes, and the two keys whose nodes may go on elsewhere (none if ``whole``)."""

    def __init__(self, root: Node, first: Entry, last: Entry, whole: bool, named: bool):
        self.first, self.last, self.whole, self.named = first, last, whole, named
        self.rows: list[list] = []
        self.open: dict[int, dict] = {0: {}, 1: {}}             # per border key: depth -> what this range adds
        self.names = {0: first.names(), 1: last.names()} if not whole else {}
        self.path = bytearray()
        self._walk(root)

    def _walk(self, root: Node) -> None:
        """Children before parents, without recursion: a conversation may have any number of turns."""
        stack = [(root, -1, None, 0, False)]
        results: list[Below] = []
        while stack:
            node, above, byte, mark, done = stack.pop()
            end = above + (byte is not None) + len(node.prefix) if byte is not None else len(node.prefix)
            if not done:
                del self.path[max(above, 0):]
                if byte is not None:
                    self.path.append(byte)
                self.path += node.prefix
                stack.append((node, above, byte, len(results), True))
                stack.extend((kid, end, b, 0, False) for b, kid in reversed(list(node.children())))
                continue
            below = Below()
            for r in results[mark:]:
                below.take(r)
            del results[mark:]
            if node.value is not None:
                below.first |= node.value is self.first
                below.last |= node.value is self.last
                below.through.append(node.value)
            for depth in range(end // WIDTH, above // WIDTH if above >= 0 else -1, -1):
                below = self._node(depth, below)
            results.append(below)

    def _node(self, depth: int, below: Below) -> Below:
        """The node at a whole-turn depth from all that hangs below it."""
        own = None
        for entry in below.through:
            if depth in entry.adds:
                own = _sum(own, entry.adds[depth])
        own = own or [0, None, 0, 0, 0, None]
        up = Below()
        up.first, up.last = below.first, below.last
        up.through = [e for e in below.through if e.least < depth]
        if not self.whole and (below.first or below.last):
            side = 0 if below.first else 1
            self.open[side][depth] = _sum(own, [below.n, below.low, below.children, below.leaves, below.saved, None])
            for i in below.tops:
                self.rows[i][9] = self.names[side][depth]
            return up
        n, low = own[0] + below.n, min(x for x in (own[1], below.low) if x is not None)
        children = own[2] + below.children
        leaves = own[3] + below.leaves if children else 1
        words = int.from_bytes(self.path[depth * WIDTH - COUNT:depth * WIDTH], "big") if depth else 0
        saved = own[4] + below.saved + (n - 1) * words
        name = below.through[0].names()[depth] if self.named else None
        for i in below.tops:
            self.rows[i][2] = low
        up.n, up.low, up.children, up.leaves, up.saved = n, low, 1, leaves, saved
        up.tops = [len(self.rows)]
        self.rows.append([low, depth, None, n, children, leaves, saved, own[5] or _EMPTY, name, None])
        return up

    def batches(self):
        for a in range(0, len(self.rows), 4096):
            columns = list(zip(*self.rows[a:a + 4096]))
            n = len(columns[0])
            yield _batch(columns, [None] * n, [None] * n)
        if not self.whole:
            sides = [(0, self.first), (1, self.last)][:1 if self.first is self.last else 2]
            adds = [[dict(zip(("depth", "n", "low", "children", "leaves", "saved", "ends"), (d, *x)))
                     for d, x in sorted(self.open[s].items())] for s, _ in sides]
            yield _batch([[None] * len(sides)] * 10, [e.key for _, e in sides], adds)


def _batch(columns, keys, adds) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.string(), pa.binary(), pa.binary()]
    return pa.record_batch([*(pa.array(c, k) for c, k in zip(columns, kinds)), pa.array(keys, pa.binary()), pa.array(adds, _ADDS)],
                           names=[*_NUMBERS, "ends_sha256", "node", "parent_node", "key", "adds"])


def _walked(entries, whole: bool, named: bool):
    """The rows of a range from its keys in order; equal keys come one after the other."""
    root, first, last = None, None, None
    for key, adds in entries:
        if last is not None and last.key == key:
            last.merge(adds)
            continue
        last = Entry(key, adds)
        first = first or last
        root, _ = insert(root, key, last)
    if root is not None:
        yield from Walk(root, first, last, whole, named).batches()


def _from_runs(whole: bool):
    def walk(batches):
        def entries():
            key, n, low, digest = None, 0, None, None
            for batch in batches:
                for row in batch.to_pylist():
                    if row["key"] != key:
                        if key is not None:
                            yield key, {len(key) // WIDTH: [n, low, 0, 0, 0, digest.hexdigest()]}
                        key, n, low, digest = row["key"], 0, row["first"], hashlib.sha256()
                    digest.update(("," if n else "").encode() + row["ids"].encode())
                    n += row["n"]
            if key is not None:
                yield key, {len(key) // WIDTH: [n, low, 0, 0, 0, digest.hexdigest()]}
        yield from _walked(entries(), whole, False)
    return walk


def _from_borders(whole: bool):
    def walk(batches):
        def entries():
            for batch in batches:
                for row in batch.select(["key", "adds"]).to_pylist():
                    yield row["key"], {x["depth"]: [x["n"], x["low"], x["children"], x["leaves"], x["saved"], x["ends"]]
                                       for x in row["adds"]}
        yield from _walked(entries(), whole, True)
    return walk


# --- the whole -----------------------------------------------------------------------

def _ranges(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """In ``n`` ranges of the key, each in order."""
    dealt = rows.repartitionByRange(n, "key") if n > 1 else rows.repartition(1)
    return dealt.sortWithinPartitions(*order)


def prefix_trie(convs: DataFrame, shard: int = SHARD) -> DataFrame:
    """The nodes of the trie over (conv_id, key): one row for each distinct sequence of first turns.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. The node's last turn is turn ``depth``
    of conversation conv_id.
    """
    spark = convs.sparkSession
    ship(spark)
    convs = stage(convs.select("conv_id", "key"), "conversation-keys")
    n = convs.count()
    if n == 0:
        return spark.createDataFrame([], ", ".join(f"{c} long" for c in _NUMBERS) + ", ends_sha256 string")
    spread = convs.repartitionByRange(max(-(-n // (4 * shard)), 2), "key", "conv_id").sortWithinPartitions("key", "conv_id")
    rows = stage(spread.mapInArrow(_runs, "key binary, first long, n long, ids string"), "conversation-runs")
    levels, order, walk = [], ["key", "first"], _from_runs
    while True:
        size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("key"))).first()
        parts = max(-(-size[0] // shard), -(-(size[1] or 0) // SHARD_BYTES) if size[0] > 2 else 1, 1)
        level = stage(_ranges(rows, order, parts).mapInArrow(walk(parts == 1), _SCHEMA), "trie-level")
        levels.append(level.where("adds IS NULL"))
        if parts == 1:
            break
        rows, order, walk = level.where("adds IS NOT NULL").select("key", "adds"), ["key"], _from_borders
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    return _with_parents(nodes, levels[1:])


def _with_parents(nodes: DataFrame, later: list[DataFrame]) -> DataFrame:
    """The smallest member of parents that were finished in a later level."""
    columns = [*_NUMBERS, "ends_sha256"]
    if not later:
        return nodes.select(columns)
    hubs = later[0]
    for level in later[1:]:
        hubs = hubs.unionByName(level)
    hubs = hubs.select(F.col("node").alias("hub"), F.col("conv_id").alias("hub_conv"))
    hubs = F.broadcast(hubs) if hubs.count() <= SMALL else hubs         # a row for each turn of two keys per range
    return (nodes.join(hubs, F.col("parent_node") == F.col("hub"), "left")
            .withColumn("parent_conv_id", F.coalesce("hub_conv", "parent_conv_id")).select(columns))
