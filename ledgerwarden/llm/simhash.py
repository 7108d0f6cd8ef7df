"""Operator 8: SimHash near-duplicates, linked exactly within a Hamming radius.

Fingerprints: the 64 majority bits of XXH64 over the word shingles of a text.
Equal fingerprints are pre-aggregated; the distinct ones are linked by search
in vantage-point trees:

1. Shards by projected distance 0. Of ``radius + j`` blocks of bits, two
   fingerprints within ``radius`` agree on some j blocks, so each fingerprint
   goes to one shard per choice of j blocks (j grows with the number of
   fingerprints, so that shards stay small).
2. A shard above ``SHARD_ROWS`` is cut by distance from its vantage point (its
   smallest fingerprint) into rings of radius + 1. By the triangle bound a
   neighbour lies in the same or an adjacent ring, so a fingerprint also
   visits the next ring where the boundary is within the radius. Rings still
   too large are dealt to cells in which every pair meets.
3. Inside, a vantage-point tree splits at the median distance; branches are
   pruned by the triangle bound, and only the bands that overlap the boundary
   are compared across it.

Each shard returns a forest of its links (at most a link per fingerprint), and
connected components join the forests.

Rows and ties. A null text, or one without words, has fingerprint 0 and is
linked like any other. Repeated rows get the same fingerprint and component. A
component is named by its smallest non-null doc_id. Empty tables give empty
results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stage, text_slices
from .groups import Forest, connected, over_runs, split_cells

SHINGLE, RADIUS, SEED = 3, 3, 42
SHARD_ROWS = 4096
LEAF = 64
_CHUNK = 1 << 15


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of a text's UTF-8 bytes."""
    from xxhash import xxh64_intdigest

    words = raw.lower().split()      # ASCII letters and white space only, as bytes
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    size = min(shingle, len(words))
    stops = ends[size - 1:].tolist()
    begins = [0, *(ends[:len(stops) - 1] + 1).tolist()]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(stops), _CHUNK):
        h = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begins[at:at + _CHUNK], stops[at:at + _CHUNK])],
                     np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(stops), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offs in text_slices(batch):
                data = raw.tobytes()
                fps = [fingerprint(data[a:b], shingle) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp as signed 64-bit) of every row; no shuffle."""
    ship(docs.sparkSession)
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(_fingerprints(shingle), "doc_id long, fp long")


# --- vantage-point search -------------------------------------------------------

def _near(x: np.ndarray, y: np.ndarray, radius: int, same: bool):
    """Index pairs (i, j) with x[i], y[j] within the radius; i < j if both are one set."""
    step = max(1, (1 << 20) // max(1, len(y)))
    for a in range(0, len(x), step):
        hit = np.bitwise_count(x[a:a + step, None] ^ y[None, :]) <= radius
        i, j = np.nonzero(hit)
        i = i + a
        if same:
            keep = i < j
            i, j = i[keep], j[keep]
        if len(i):
            yield i, j


def vp_link(points: np.ndarray, radius: int, forest: Forest, at: np.ndarray) -> None:
    """Link all points (uint64) within the radius in ``forest``, where point i has index at[i]."""
    todo = [np.arange(len(points))]
    while todo:
        own = todo.pop()
        if len(own) <= LEAF:
            for i, j in _near(points[own], points[own], radius, True):
                forest.link(at[own[i]], at[own[j]])
            continue
        d = np.bitwise_count(points[own] ^ points[own[0]]).astype(np.int64)
        median = int(np.partition(d, len(d) // 2)[len(d) // 2])
        inside = d <= median
        if inside.all():
            inside = d < median
        if not inside.any():           # all at one distance: no boundary to prune by
            for i, j in _near(points[own], points[own], radius, True):
                forest.link(at[own[i]], at[own[j]])
            continue
        border = int(d[inside].max())
        todo += [own[inside], own[~inside]]
        _cross(points, own[inside & (d > border - radius)], own[~inside & (d <= border + radius)], radius, forest, at)


def _cross(points, a: np.ndarray, b: np.ndarray, radius: int, forest: Forest, at: np.ndarray) -> None:
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        if not len(a) or not len(b):
            continue
        if min(len(a), len(b)) <= LEAF:
            for i, j in _near(points[a], points[b], radius, False):
                forest.link(at[a[i]], at[b[j]])
            continue
        da = np.bitwise_count(points[a] ^ points[a[0]]).astype(np.int64)
        db = np.bitwise_count(points[b] ^ points[a[0]]).astype(np.int64)
        median = int(np.partition(da, len(da) // 2)[len(da) // 2])
        inside = da <= median
        if inside.all():
            inside = da < median
        if not inside.any():
            for i, j in _near(points[a], points[b], radius, False):
                forest.link(at[a[i]], at[b[j]])
            continue
        border = int(da[inside].max())
        todo += [(a[inside], b[db <= border + radius]), (a[~inside], b[db > border - radius])]


def _search(radius: int):
    def work(t: pa.Table, starts: np.ndarray) -> pa.RecordBatch | None:
        fp = t.column("fp").to_numpy().view(np.uint64)
        sizes = np.diff(np.append(starts, len(fp)))
        forest = Forest(len(fp))
        run = np.repeat(np.arange(len(starts)), sizes)
        small = np.repeat(sizes <= LEAF, sizes)
        for s in range(1, int(min(LEAF, sizes.max()))):     # leaves of all small shards at once
            i = np.flatnonzero(small[:-s] & (run[s:] == run[:-s]))
            if not len(i):
                break
            i = i[np.bitwise_count(fp[i] ^ fp[i + s]) <= radius]
            forest.link(i, i + s)
        for r in np.flatnonzero(sizes > LEAF).tolist():
            a, b = int(starts[r]), int(starts[r] + sizes[r])
            vp_link(fp[a:b], radius, forest, np.arange(a, b))
        root = forest.roots()
        linked = np.flatnonzero(fp[root] != fp)
        if not len(linked):
            return None
        return pa.RecordBatch.from_arrays([pa.array(fp[linked].view(np.int64)), pa.array(fp[root[linked]].view(np.int64))],
                                          ["a", "b"])

    return work


def _masks(radius: int, blocks: int) -> list[int]:
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    parts = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    masks = [sum(parts[i] for i in c) for c in combinations(range(blocks), blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A spanning forest (a, b) of the links between distinct fingerprints ``fps`` (fp) within the radius."""
    n = fps.count()
    blocks = radius + 1
    while blocks < radius + 3 and n >> (64 * (blocks - radius) // blocks) > 64:
        blocks += 1
    masks = ", ".join(f"named_struct('c', {i}, 'v', fp & {m}L)" for i, m in enumerate(_masks(radius, blocks)))
    rows = fps.selectExpr("fp", f"explode(array({masks})) k").selectExpr("fp", "k.c c", "k.v v")
    hot = stage(rows.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("vp"))
                .where(F.col("n") > shard_rows).drop("n"), "hot")
    n_hot = hot.count()
    key = ["c", "v", "ring", "cell"]
    if not n_hot:
        dealt = rows.withColumn("ring", F.lit(0)).withColumn("cell", F.lit(0))
    else:
        from .groups import join_counted

        width = radius + 1
        ringed = join_counted(rows, hot, ["c", "v"], n_hot).withColumn(
            "d", F.expr("coalesce(bit_count(fp ^ vp), 0)"))
        home = f"CAST(floor(d / {width}) AS INT)"
        ringed = ringed.withColumn("ring", F.explode(F.expr(
            f"CASE WHEN vp IS NULL OR d % {width} = 0 THEN array({home}) ELSE array({home}, {home} + 1) END")))
        dealt = split_cells(ringed.drop("vp", "d"), ["c", "v", "ring"], "fp", shard_rows)
    sorted_rows = dealt.select(*key, "fp").repartition(*key).sortWithinPartitions(*key, "fp")
    return sorted_rows.mapInArrow(over_runs(key, _search(radius)), "a long, b long")


def components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
               shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text)."""
    fps = stage(fingerprints(docs, shingle), "fingerprints")
    classes = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    roots = connected(links(classes.select("fp"), radius, shard_rows))
    members = roots.selectExpr("node fp", "root").unionAll(roots.selectExpr("root fp", "root").distinct())
    named = (members.join(classes, "fp").groupBy("root").agg(F.min("rep").alias("least")))
    linked = members.join(named, "root").select("fp", "least")
    names = stage(classes.join(linked, "fp", "left").selectExpr("fp", "coalesce(least, rep) component_id"), "components")
    return fps.join(names, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component, the one of the smallest doc_id, with all its columns.

    Rows that share a kept doc_id count as one document: the row of the
    smallest text stays. Rows with a null doc_id are kept only where no row of their
    component has one, one for each fingerprint class.
    """
    found = stage(components(docs, shingle, radius), "near-duplicates")
    tally = found.where("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("__lw_rows"))
    chosen = stage(tally, "kept")
    names = docs.columns
    known = docs.where("doc_id IS NOT NULL").withColumn("__lw_id", F.col("doc_id").cast("long"))
    kept = known.join(chosen.withColumnRenamed("doc_id", "__lw_id"), "__lw_id")
    out = kept.where("__lw_rows = 1").select(*names)
    if chosen.where("__lw_rows > 1").limit(1).count():
        again = kept.where("__lw_rows > 1").groupBy("__lw_id").agg(
            F.min_by(F.struct(*[F.col(c) for c in names]), F.struct(F.col("text").isNull(), F.col("text"))).alias("__lw_row"))
        out = out.unionAll(again.select("__lw_row.*"))
    if found.where("component_id IS NULL").limit(1).count():
        blank = docs.where("doc_id IS NULL")
        lone = found.where("component_id IS NULL").select("fp").distinct()
        texts = blank.withColumn("__lw_n", F.monotonically_increasing_id())
        marked = stage(texts, "no-id")
        fp = fingerprints(marked.selectExpr("__lw_n doc_id", "text"), shingle).withColumnRenamed("doc_id", "__lw_n")
        first = fp.join(lone, "fp").groupBy("fp").agg(F.min("__lw_n").alias("__lw_n")).select("__lw_n")
        out = out.unionAll(marked.join(first, "__lw_n").select(*names))
    return out
