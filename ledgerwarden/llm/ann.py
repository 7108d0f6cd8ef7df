"""Operator 2: nearest neighbours by a hash-prefix forest.

A tree is a sorted array of long hash strings (``BITS`` sign bits of random
orthogonal projections, most significant first) with the rows they belong to.
For a query, every tree descends bit by bit to the range of rows that share a
prefix with the query's string; from the longest prefixes all trees then ascend
together, one bit at a time, until the rows that share that many bits in some
tree are enough. Those candidates are ranked by exact inner product in double
precision.

Vectors are dealt by hash into shards of about ``SHARD_ROWS``, and queries come
to every shard in blocks. For inner product, rows get one more coordinate that
makes all norms equal, which leaves the order of inner products as that of
angles. Where lengths differ much that coordinate would decide the bits, so a
shard's rows are cut by length into bands, none with a row shorter than
``BAND`` times its longest, each with a forest of its own. Bands are searched
from the longest down; one is left out for a query only where no row of it can
reach the k-th score found so far (|q| times the band's longest row).
Enough means the share ``CANDIDATES`` of the band, and ``PER_NEIGHBOUR`` rows for each neighbour
wanted: neighbours of nearly random vectors, as here,
share few bits, so the share needed for recall 0.9 is large; set it lower for
data with real clusters.

Rows and ties. Vectors that are null, empty, zero, or hold null or non-finite
components take no part; nor do those whose length is not the most frequent
one (ties: the shortest). Equal scores go to the smaller id. A repeated id is
one candidate (its smallest components in order); fewer than k candidates
are all returned. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import ship, stage

BITS, TREES = 64, 24
SHARD_ROWS, BLOCK_QUERIES = 8192, 1024
CANDIDATES = 0.6
PER_NEIGHBOUR = 8
#: The shortest row of a band is at least this share of its longest.
BAND = 0.8
SEED = 5


@lru_cache(maxsize=1)
def planes(dim: int, trees: int = TREES, seed: int = SEED) -> np.ndarray:
    """(trees, BITS, dim) directions; within a tree as many as possible are orthogonal."""
    rng = np.random.default_rng(seed)
    out = np.empty((trees, BITS, dim))
    for t in range(trees):
        rows: list[np.ndarray] = []
        while len(rows) < BITS:
            q, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
            rows += list(q.T)
        out[t] = rows[:BITS]
    return out


def strings(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """(trees, rows) hash strings as unsigned 64-bit integers."""
    weight = np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)
    return np.stack([((x @ d.T) >= 0).astype(np.uint64) @ weight for d in p])


class PrefixForest:
    """The forest of one band: rows (n, dim), their ids and the length of the longest."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, top_norm: float, trees: int = TREES, seed: int = SEED):
        self.ids, self.rows = ids, np.ascontiguousarray(rows)
        self.planes = planes(rows.shape[1] + 1, trees, seed)
        spare = np.sqrt(np.maximum(top_norm ** 2 - np.einsum("ij,ij->i", rows, rows), 0))
        keys = strings(np.hstack([rows, spare[:, None]]), self.planes)
        self.order = np.argsort(keys, axis=1, kind="stable")
        self.keys = np.take_along_axis(keys, self.order, axis=1)

    def hash(self, queries: np.ndarray) -> np.ndarray:
        return strings(np.hstack([queries, np.zeros((len(queries), 1))]), self.planes)

    def ranges(self, marks: np.ndarray, least: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Descend: for each prefix length, from 1, every tree's range for every query (trees, queries).

        Stops at the length at which no query's ranges hold ``least`` rows any more.
        """
        found = []
        for depth in range(1, BITS + 1):
            shift = np.uint64(BITS - depth)
            low = (marks >> shift) << shift
            high = low | ((np.uint64(1) << shift) - np.uint64(1))
            found.append((np.stack([np.searchsorted(k, x) for k, x in zip(self.keys, low)]),
                          np.stack([np.searchsorted(k, x, "right") for k, x in zip(self.keys, high)])))
            if not ((found[-1][1] - found[-1][0]).sum(axis=0) >= least).any():
                break
        return found

    def candidates(self, ranges: list[tuple[np.ndarray, np.ndarray]], q: int, least: int) -> np.ndarray:
        """Ascend from the longest prefixes, in all trees at once, until ``least`` rows share that many bits in a tree."""
        least = min(least, len(self.ids))
        for low, high in reversed(ranges):
            a, b = low[:, q], high[:, q]
            if int((b - a).sum()) < least:
                continue
            seen = np.zeros(len(self.ids), bool)
            for t in range(len(a)):
                seen[self.order[t, a[t]:b[t]]] = True
            if int(seen.sum()) >= least:
                return np.flatnonzero(seen)
        return np.arange(len(self.ids))

    def nearest(self, query_id: int, query: np.ndarray, at: np.ndarray, k: int):
        """The k best of the rows ``at`` by inner product in double precision; equal ones by id."""
        at = at[self.ids[at] != query_id]
        s = np.einsum("ij,j->i", self.rows[at], query)       # each row alone: equal rows score alike
        if len(s) > k:
            edge = np.partition(s, len(s) - k)[len(s) - k]
            keep = s >= edge
            at, s = at[keep], s[keep]
        best = np.lexsort((self.ids[at], -s))[:k]
        return self.ids[at][best], s[best]


class BandedForest:
    """A shard's rows in bands by length, longest first, each with its forest."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, trees: int = TREES, seed: int = SEED):
        norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
        order = np.argsort(-norms, kind="stable")
        falling = -norms[order]
        self.bands: list[tuple[float, PrefixForest]] = []
        start = 0
        while start < len(order):
            top = float(-falling[start])
            end = int(np.searchsorted(falling, -BAND * top, "right"))
            at = order[start:end]
            self.bands.append((top, PrefixForest(ids[at], rows[at], top, trees, seed)))
            start = end

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, share: float) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of the k best found for each query."""
        marks = self.bands[0][1].hash(queries)                # the same in all bands
        lengths = np.sqrt(np.einsum("ij,ij->i", queries, queries))
        found = [(np.zeros(0, np.int64), np.zeros(0))] * len(ids)
        edge = np.full(len(ids), -np.inf)                     # k-th score so far
        for top, forest in self.bands:
            open_ = np.flatnonzero(~(lengths * top * (1 + 1e-9) < edge))     # an equal score may have a smaller id
            if not len(open_):
                break
            least = max(PER_NEIGHBOUR * k, int(np.ceil(share * len(forest.ids))))
            ranges = forest.ranges(marks[:, open_], least) if least < len(forest.ids) else []
            for i, j in enumerate(open_.tolist()):
                new, s = forest.nearest(int(ids[j]), queries[j], forest.candidates(ranges, i, least), k)
                new, s = np.concatenate([found[j][0], new]), np.concatenate([found[j][1], s])
                best = np.lexsort((new, -s))[:k]
                found[j] = new[best], s[best]
                if len(best) == k:
                    edge[j] = s[best[-1]]
        return found


def usable(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, v: array<double>) of the vectors that take part, one row for each id."""
    v = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(column).cast("array<double>").alias("v"))
    whole = ("id IS NOT NULL AND v IS NOT NULL AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity')) "
             "AND exists(v, x -> x <> 0)")
    return v.where(whole).groupBy("id").agg(F.min("v").alias("v"))


def _unpack(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _search(k: int, share: float, trees: int, seed: int):
    names = ["query_id", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, of = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.slice(i, 1)
                shard = part.column("shard")[0].as_py()
                if of != shard:
                    rows = part.column("rows").flatten()
                    forest, of = BandedForest(rows.field("id").to_numpy(), _unpack(rows.field("v")), trees, seed), shard
                asked = part.column("queries").flatten()
                ids, vectors = asked.field("id").to_numpy(), _unpack(asked.field("v"))
                out = forest.search(ids, vectors, k, share)
                sizes = [len(o[0]) for o in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, sizes)), pa.array(np.concatenate([o[0] for o in out])),
                     pa.array(np.concatenate([o[1] for o in out]))], names)

    return run


def nearest(vectors: DataFrame, is_query: str, k: int = 20, share: float = CANDIDATES, trees: int = TREES,
            seed: int = SEED, shard_rows: int = SHARD_ROWS, block: int = BLOCK_QUERIES,
            id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row for which ``is_query`` (SQL over ``id``) holds."""
    spark = vectors.sparkSession
    ship(spark)
    v = stage(usable(vectors, id_column, column), "vectors")
    sizes = v.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    top = min(sizes, key=lambda r: (-r.n, r.d))
    v = v.where(F.size("v") == top.d)
    shards = -(-top.n // shard_rows)
    queries = v.where(is_query)
    blocks = max(1, -(-queries.count() // block))
    pair = F.struct("id", "v")
    rows = (v.withColumn("shard", F.expr(f"CAST(pmod(xxhash64(id, 1), {shards}) AS INT)"))
            .groupBy("shard").agg(F.sort_array(F.collect_list(pair)).alias("rows")))          # bounded by shard_rows
    asked = (queries.withColumn("b", F.expr(f"CAST(pmod(xxhash64(id, 2), {blocks}) AS INT)"))
             .groupBy("b").agg(F.sort_array(F.collect_list(pair)).alias("queries")))          # bounded by block
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    met = asked.join(rows.hint("shuffle_merge"), "shard").repartition(shards * blocks, "shard", "b")
    found = met.select("shard", "rows", "queries").mapInArrow(
        _search(k, share, trees, seed), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
