"""Operator 3: line dedup by an exact set-similarity join.

A line is a ``\\n``-separated part of a text that holds a word. Its set has the
``SHINGLE``-word shingles of its words (ASCII letters lowered; a shorter line is
one shingle), and two lines are linked when the Jaccard similarity of their
sets is at least ``NUM / DEN``. A line is removed if an earlier line, by
(doc_id, line number), is linked to it or has the same words.

1. One pass over the texts gives a row for each line (hash of its words, place)
   and a count sketch of the shingles (2**SKETCH_BITS counters, fixed size).
   Lines of equal words are one class, with its first place.
2. A second pass orders each class's set by rarity (sketch count, then hash)
   and sends its prefix, the n - ceil(t n) + 1 rarest, to shards by shingle; in
   each shard the length and positional filters leave the classes that can
   have a partner; of groups with the same members the rarest shingle's stays.
   A task sends a class once, so frequent lines cost little.
3. The sets of those classes only are read again and met by shared prefix
   shingle; the overlaps are counted exactly (products of 0/1 matrices over the
   shared shingles), a pair being counted at its first common shingle only.
   Groups above ``GROUP_ROWS`` are dealt to cells in which all pairs meet.

Any order of shingles gives the same result; rarity keeps the groups small.
Shingles and lines are told apart by 64-bit hashes.

Rows and ties. A null text has no lines. Rows of one doc_id count as one
document: equal lines at the same place are kept or removed alike (as in the
operator's SQL). A null doc_id comes after all others, and rows without an id
are one document too; lists of lines are kept by id and hash of the text, so
they hold one text's lines however many rows share an id. Blank lines stay. A document whose lines all go
keeps its row with an empty text. Empty tables give empty results. Other
columns pass through ``dedup_documents``; n_chars, if present, is the new length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, large, mix64, multipliers, run_hashes, ship, stage, text_slices, words_of
from .groups import over_runs, split_cells

SHINGLE, NUM, DEN = 5, 4, 5
SKETCH_BITS = 20
SKETCH_CHUNK = 1 << 14
GROUP_ROWS = 1024
#: A shingle counted more often than this (beyond the sketch's usual noise) is dealt by line as well.
HOT_SHINGLE = 1 << 20
#: Candidate lines (8 bytes each, in lists by text) up to which the lists are broadcast.
WANTED_LINES = 1_000_000
#: Line classes that a task remembers as sent.
SEEN = 500_000
LAST = (1 << 63) - 1


class Lines:
    """The lines of a slice of texts that hold a word."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        raw = LOWER[raw]
        cuts = np.unique(np.concatenate([np.flatnonzero(raw == 10) + 1, offsets[:-1]]))
        starts, ends = words_of(raw, offsets)
        self.words = run_hashes(raw, starts, ends)
        at = np.searchsorted(cuts, starts, "right") - 1          # the line of each word
        first = np.flatnonzero(np.diff(at, prepend=-1))
        self.begin, self.end = first, np.append(first[1:], len(at)).astype(np.int64)
        spot = cuts[at[first]]
        self.doc = np.searchsorted(offsets[1:], spot, "right")
        breaks = np.concatenate([[0], np.cumsum(raw == 10)])
        self.number = breaks[spot] - breaks[offsets[self.doc]]
        self.hash = run_hashes(self.words, self.begin, self.end)

    def __len__(self) -> int:
        return len(self.begin)

    def shingles(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(line, hash) of every shingle of the chosen lines (places in this object), repeats included."""
        size = self.end[chosen] - self.begin[chosen]
        short, long = chosen[size < SHINGLE], chosen[size >= SHINGLE]
        lines, keys = [short], [mix64(self.hash[short])]
        if len(long):
            count = self.end[long] - self.begin[long] - SHINGLE + 1
            line = np.repeat(long, count)
            at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + self.begin[line]
            m = multipliers(SHINGLE, seed=3)
            with np.errstate(over="ignore"):
                key = np.zeros(len(at), np.uint64)
                for j in range(SHINGLE):
                    key += self.words[at + j] * m[j]
            lines.append(line)
            keys.append(mix64(key))
        return np.concatenate(lines), np.concatenate(keys)


def bucket(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def ordered_sets(lines: np.ndarray, keys: np.ndarray, sketch: np.ndarray):
    """(line, hash, size of the line's set, position), lines in order, each set by rarity."""
    rare = sketch[bucket(keys)]
    order = np.lexsort((keys, rare, lines))
    lines, keys = lines[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (lines[1:] != lines[:-1])
    lines, keys = lines[new], keys[new]
    first = np.flatnonzero(np.diff(lines, prepend=-1))
    size = np.diff(np.append(first, len(lines)))
    return lines, keys, np.repeat(size, size), np.arange(len(lines)) - np.repeat(first, size)


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - (NUM * n + DEN - 1) // DEN + 1


def similar(overlap, n, m):
    """Jaccard of sets of sizes n and m with this overlap is at least NUM / DEN."""
    return overlap * (DEN + NUM) >= NUM * (n + m)


# --- pass 1: lines and sketch --------------------------------------------------

OCCURRENCES = "h long, doc long, key long, line int, chunk int, counts binary"


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
    names = ["h", "doc", "key", "line", "chunk", "counts"]
    for batch in batches:
        for part, raw, offs in text_slices(batch):
            found = Lines(raw, offs)
            _, keys = found.shingles(np.arange(len(found)))
            sketch += np.bincount(bucket(keys), minlength=1 << SKETCH_BITS).astype(np.uint32)
            docs, texts = (part.column(c).to_numpy()[found.doc] for c in ("doc", "key"))
            n = len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.hash.view(np.int64)), pa.array(docs), pa.array(texts), pa.array(found.number.astype(np.int32)),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
    if sketch.any():
        parts = sketch.reshape(-1, SKETCH_CHUNK)
        n = len(parts)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()),
             pa.array(np.arange(n, dtype=np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())], names)


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for c, raw in zip(batch.column("chunk").to_pylist(), batch.column("counts")):
            counts = np.frombuffer(raw.as_buffer(), np.uint32).astype(np.uint64)
            total[c] = total[c] + counts if c in total else counts
    keys = sorted(total)
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([total[k].tobytes() for k in keys], pa.binary())],
                                      ["chunk", "counts"])


def _sketch(occurrences: DataFrame) -> np.ndarray:
    """The counters of all tasks added up: a fixed 2**SKETCH_BITS numbers come to the driver."""
    parts = (occurrences.where("chunk IS NOT NULL").select("chunk", "counts").repartition("chunk")
             .mapInArrow(_add_counts, "chunk int, counts binary").collect())
    sketch = np.zeros(1 << SKETCH_BITS, np.uint64)
    for r in parts:
        sketch[r.chunk * SKETCH_CHUNK:(r.chunk + 1) * SKETCH_CHUNK] = np.frombuffer(r.counts, np.uint64)
    return np.minimum(sketch, np.uint64(0xFFFFFFFF)).astype(np.uint32)


# --- pass 2: prefixes -----------------------------------------------------------

HOT_BIT = np.uint32(1 << 31)


def _prefixes(sketch, n_shards: int, hot: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        hot_above = int(np.median(counts)) + hot
        seen: set[int] = set()
        held: list[tuple] = []
        n_held = 0

        def flush():
            t, h, n, p = (np.concatenate(c) for c in zip(*held))
            key = np.where(p & HOT_BIT != 0, mix64(t ^ mix64(h)), t)
            shard = (mix64(key) % np.uint64(n_shards)).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            ids, first = np.unique(shard[order], return_index=True)
            blobs = [b"".join(np.ascontiguousarray(c[order[a:b]]).tobytes() for c in (t, h, n, p))
                     for a, b in zip(first, np.append(first[1:], len(order)))]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "rows"])

        for batch in batches:
            for _, raw, offs in text_slices(batch):
                found = Lines(raw, offs)
                _, once = np.unique(found.hash, return_index=True)
                once = np.array([i for i, h in zip(once.tolist(), found.hash[once].tolist()) if h not in seen], np.int64)
                if len(seen) > SEEN:
                    seen.clear()
                seen.update(found.hash[once].tolist())
                line, t, n, p = ordered_sets(*found.shingles(once), counts)
                lead = p < prefix_length(n)
                line, t, n, p = line[lead], t[lead], n[lead].astype(np.uint32), p[lead].astype(np.uint32)
                p |= np.where(counts[bucket(t)] > hot_above, HOT_BIT, np.uint32(0))
                if len(t):
                    held.append((t, found.hash[line], n, p))
                    n_held += len(t)
                if n_held > 600_000:
                    yield flush()
                    held.clear()
                    n_held = 0
        if held:
            yield flush()

    return run


def _partners(t: np.ndarray, h: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Which rows, sorted by (t, h), can have a partner with the same t: length and positional filter."""
    active = p & HOT_BIT != 0
    place = (p & ~HOT_BIT).astype(np.int64)
    n = n.astype(np.int64)
    first = np.flatnonzero(np.diff(t, prepend=t[0] ^ np.uint64(1)))
    size = np.diff(np.append(first, len(t)))
    run = np.repeat(np.arange(len(first)), size)
    of = np.repeat(size, size)
    active |= of > 64
    for s in range(1, int(min(size.max(), 64))):
        i = np.flatnonzero((run[s:] == run[:-s]) & (of[s:] <= 64))
        if not len(i):
            break
        j = i + s
        most = 1 + np.minimum(n[i] - place[i], n[j] - place[j]) - 1
        ok = similar(most, n[i], n[j]) & (DEN * np.minimum(n[i], n[j]) >= NUM * np.maximum(n[i], n[j]))
        active[i[ok]] = True
        active[j[ok]] = True
    return active


def _meet(sketch):
    """Candidate rows (t, its count, h) of the shards of a partition, which come one after the other."""
    def work(blobs: list):
        parts = [np.frombuffer(b, np.uint8) for b in blobs]
        cols = [[], [], [], []]
        for b in parts:
            k = len(b) // 24
            for c, (lo, hi, kind) in zip(cols, [(0, 8, np.uint64), (8, 16, np.uint64), (16, 20, np.uint32), (20, 24, np.uint32)]):
                c.append(np.frombuffer(b[lo * k:hi * k], kind))
        t, h, n, p = (np.concatenate(c) for c in cols)
        order = np.lexsort((h, t))
        t, h, n, p = t[order], h[order], n[order], p[order]
        new = np.ones(len(t), bool)
        new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
        t, h, n, p = t[new], h[new], n[new], p[new]
        active = _partners(t, h, n, p)
        t, h = t[active], h[active]
        return pa.RecordBatch.from_arrays(
            [pa.array(t.view(np.int64)), pa.array(sketch.value[bucket(t)].astype(np.int64)), pa.array(h.view(np.int64))],
            ["t", "r", "h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for s, b in zip(batch.column("shard").to_pylist(), batch.column("rows")):
                if s != now and held:
                    yield work(held)
                    held = []
                now = s
                held.append(b.as_buffer().to_pybytes())
        if held:
            yield work(held)

    return run


def _distinct_groups(candidates: DataFrame) -> DataFrame:
    """The candidate groups (t, h) without those that have the members of a rarer shingle's group.

    A pair is verified and counted in the group of its first common shingle. That group
    stays: a group of the same members under a rarer shingle would hold a common
    shingle before the first. Members are compared by count and 128 bits of hashes.
    """
    groups = candidates.groupBy("t").agg(
        F.first("r").alias("r"), F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(h, 1))").alias("s1"),
        F.expr("bit_xor(xxhash64(h, 2))").alias("s2")).where("n > 1")
    first = groups.groupBy("n", "s1", "s2").agg(F.min(F.struct("r", F.expr("t < 0").alias("high"), "t")).alias("m"))
    return candidates.select("t", "h").join(first.selectExpr("m.t t"), "t", "left_semi")


# --- sets of candidates and exact overlaps ------------------------------------

def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, its set's hashes in ascending order) of the wanted lines of each text."""
    for batch in batches:
        for part, raw, offs in text_slices(batch):
            found = Lines(raw, offs)
            wanted = [set(x) for x in part.column("wanted").to_pylist()]
            signed = found.hash.view(np.int64).tolist()
            chosen = np.array([i for i, (d, h) in enumerate(zip(found.doc.tolist(), signed)) if h in wanted[d]], np.int64)
            line, key = found.shingles(chosen)
            order = np.lexsort((key, line))
            line, key = line[order], key[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (line[1:] != line[:-1])
            line, key = line[new], key[new]
            first = np.flatnonzero(np.diff(line, prepend=-1))
            ends = np.append(first[1:], len(line))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.hash[line[first]].view(np.int64)),
                 pa.array([key[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())], ["h", "keys"])


def _overlaps(sketch):
    def work(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch | None:
        counts = sketch.value
        t = table.column("t").to_numpy().view(np.uint64)
        h, doc, line = (table.column(c).to_numpy() for c in ("h", "doc", "line"))
        chunk, own = table.column("chunk").to_numpy(), table.column("own").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for chunk_ in table.column("keys").chunks for x in chunk_]
        out: list[tuple] = []
        for a, b in zip(starts.tolist(), np.append(starts[1:], len(t)).tolist()):
            if b - a < 2:
                continue
            part = sets[a:b]
            sizes = np.array([len(s) for s in part], np.int64)
            member = np.repeat(np.arange(b - a), sizes)
            keys, inverse, times = np.unique(np.concatenate(part), return_inverse=True, return_counts=True)
            shared = np.flatnonzero(times > 1)
            order = shared[np.lexsort((keys[shared], counts[bucket(keys[shared])]))]   # rarest first
            rank = np.full(len(keys), -1, np.int64)
            rank[order] = np.arange(len(order))
            cut = int(rank[np.searchsorted(keys, t[a])])
            column = rank[inverse]
            keep = column >= 0
            member, column = member[keep], column[keep]
            by_column = np.argsort(column, kind="stable")
            member, column = member[by_column], column[by_column]
            step = 256
            for lo in range(0, b - a, step):
                hi = min(lo + step, b - a)
                overlap = np.zeros((hi - lo, b - a), np.float32)
                before = np.zeros((hi - lo, b - a), np.float32)
                for c0 in range(0, len(order), 2048):
                    c1 = min(c0 + 2048, len(order))
                    i, j = np.searchsorted(column, [c0, c1])
                    m = np.zeros((b - a, c1 - c0), np.float32)
                    m[member[i:j], column[i:j] - c0] = 1
                    overlap += m[lo:hi] @ m.T
                    if c0 < cut:
                        k = min(cut, c1) - c0
                        before += m[lo:hi, :k] @ m[:, :k].T
                linked = similar(overlap, sizes[lo:hi, None], sizes[None, :])
                linked &= own[a + lo:a + hi, None] | (chunk[a + lo:a + hi, None] != chunk[None, a:b])
                linked[np.arange(hi - lo), np.arange(lo, hi)] = False
                fresh = (linked & (before == 0)).sum(axis=1)
                for r in np.flatnonzero(linked.any(axis=1)).tolist():
                    near = a + np.flatnonzero(linked[r])
                    best = near[np.lexsort((line[near], doc[near]))[0]]
                    out.append((h[a + lo + r], int(fresh[r]), doc[best], line[best]))
        if not out:
            return None
        cols = list(zip(*out))
        return pa.RecordBatch.from_arrays(
            [large(list(c), k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32()))],
            ["h", "links", "doc", "line"])

    return work


# --- the operator ----------------------------------------------------------------

def _keyed(docs: DataFrame, *names: str) -> DataFrame:
    """``names`` with doc (a null doc_id is LAST) and key, a hash of the text that tells rows of one doc apart."""
    return docs.select(*names, F.expr(f"coalesce(CAST(doc_id AS LONG), {LAST})").alias("doc"), F.xxhash64("text").alias("key"))


def _wanted(candidates: DataFrame, classes: DataFrame) -> DataFrame:
    """(doc, key, wanted): the candidate lines to read from a text, bounded by its lines."""
    return (candidates.select("h").distinct().join(classes, "h")
            .groupBy(F.col("first.doc").alias("doc"), "key").agg(F.collect_list("h").alias("wanted")))


def _texts_wanted(texts: DataFrame, wanted: DataFrame, limit: int) -> DataFrame:
    """Texts with their wanted lines; the lists are broadcast only if they hold ``limit`` lines at most in all."""
    total = wanted.agg(F.sum(F.size("wanted"))).first()[0] or 0
    return texts.join(F.broadcast(wanted) if total <= limit else wanted, ["doc", "key"])


def judge_lines(docs: DataFrame, group_rows: int = GROUP_ROWS, hot: int = HOT_SHINGLE,
                wanted_lines: int = WANTED_LINES) -> DataFrame:
    """A row for each line that holds a word.

    doc_id, line_no (from 0), h (hash of its words), class_doc and class_line
    (the first place of lines of its words), n_links (other classes linked to
    it), matched_doc and matched_line (the earliest line it repeats, if it is
    removed) and removed.
    """
    return _judged(docs, group_rows, hot, wanted_lines).drop("key")


def _judged(docs: DataFrame, group_rows: int = GROUP_ROWS, hot: int = HOT_SHINGLE, wanted_lines: int = WANTED_LINES) -> DataFrame:
    """The rows of ``judge_lines`` with the key of their text."""
    spark = docs.sparkSession
    ship(spark)
    texts = _keyed(docs, "text")
    told = stage(texts.mapInArrow(_occurrences, OCCURRENCES), "lines")
    sketch = spark.sparkContext.broadcast(_sketch(told))          # 2**SKETCH_BITS counters
    lines = told.where("chunk IS NULL").select("h", "doc", "key", "line")
    classes = stage(lines.groupBy("h").agg(F.min(F.struct("doc", "line", "key")).alias("m"))
                    .selectExpr("h", "named_struct('doc', m.doc, 'line', m.line) first", "m.key key"), "line-classes")

    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = texts.mapInArrow(_prefixes(sketch, 2 * width, hot), "shard int, rows binary")
    found = stage(sent.repartition(width, "shard").sortWithinPartitions("shard")
                  .mapInArrow(_meet(sketch), "t long, r long, h long"), "shared")
    candidates = stage(_distinct_groups(found), "candidates")

    wanted = stage(_wanted(candidates, classes), "wanted")
    sets = (_texts_wanted(texts, wanted, wanted_lines)
            .mapInArrow(_sets, "h long, keys binary").groupBy("h").agg(F.first("keys").alias("keys")))
    sets = stage(sets.join(classes, "h").select("h", "keys", "first.doc", "first.line"), "line-sets")
    met = split_cells(candidates, ["t"], "h", group_rows).join(sets, "h")
    key = ["t", "cell"]
    near = (met.select("t", "cell", "chunk", "own", "h", "doc", "line", "keys").repartition(*key)
            .sortWithinPartitions(*key).mapInArrow(over_runs(key, _overlaps(sketch), 50_000),
                                                   "h long, links long, doc long, line int"))
    links = near.groupBy("h").agg(F.sum("links").alias("links"), F.min(F.struct("doc", "line")).alias("best"))
    judged = stage(classes.drop("key").join(links, "h", "left"), "line-verdicts")
    place = "named_struct('doc', doc, 'line', line)"
    early = "least(IF(first < place, first, NULL), IF(best < place, best, NULL))"
    return (lines.join(judged, "h").withColumn("place", F.expr(place)).withColumn("early", F.expr(early))
            .selectExpr(f"nullif(doc, {LAST}) doc_id", "line line_no", "h", f"nullif(first.doc, {LAST}) class_doc",
                        "first.line class_line", "coalesce(links, 0L) n_links", f"nullif(early.doc, {LAST}) matched_doc",
                        "early.line matched_line", "early IS NOT NULL removed", "key"))


def _without(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offs in text_slices(batch):
                texts = part.column("text").to_pylist()
                gone = part.column("__lw_gone").to_pylist()
                found = Lines(raw, offs)
                drop: dict[int, set[int]] = {}
                places = [None if g is None else {(x["line_no"], x["h"]) for x in g} for g in gone]
                for d, number, h in zip(found.doc.tolist(), found.number.tolist(), found.hash.view(np.int64).tolist()):
                    if places[d] is not None and (number, h) in places[d]:
                        drop.setdefault(d, set()).add(number)
                for d, numbers in drop.items():
                    texts[d] = "\n".join(x for i, x in enumerate(texts[d].split("\n")) if i not in numbers)
                cols = []
                for f in names:
                    c = part.column(f)
                    cols.append(pa.array(texts, c.type) if f == "text" else pa.array(
                        [len(texts[i]) if i in drop else v for i, v in enumerate(c.to_pylist())], c.type)
                        if f == "n_chars" else c)
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


def _gone(docs: DataFrame) -> DataFrame:
    """(doc, key, __lw_gone): the lines removed from a text."""
    return (_judged(docs).where("removed").groupBy(F.expr(f"coalesce(doc_id, {LAST})").alias("doc"), "key")
            .agg(F.collect_set(F.struct("line_no", "h")).alias("__lw_gone")))


def dedup_documents(docs: DataFrame) -> DataFrame:
    """``docs`` without the removed lines; all rows and columns stay."""
    names = docs.columns
    places = _keyed(docs, F.struct(*names).alias("__lw_row"))
    met = places.join(_gone(docs), ["doc", "key"], "left")
    return met.select("__lw_row.*", "__lw_gone").mapInArrow(_without(names), docs.schema)
