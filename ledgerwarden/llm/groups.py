"""Grouped work on sorted partitions, exact splitting of large groups, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

#: A side of at most this many narrow rows is broadcast (its rows are counted first).
BROADCAST_ROWS = 50_000


def join_counted(df: DataFrame, other: DataFrame, on: list[str], n: int, how: str = "left") -> DataFrame:
    """Join with a side of n counted rows; broadcast below BROADCAST_ROWS, shuffled beyond."""
    return df.join(F.broadcast(other) if n <= BROADCAST_ROWS else other, on, how)


def split_cells(rows: DataFrame, key: list[str], member: str, limit: int) -> DataFrame:
    """Add ``cell``, ``chunk`` and ``own``: groups above ``limit`` rows are dealt to cells so that all pairs meet.

    A group of n rows has c = ceil(n / limit) chunks by a hash of ``member``; a
    cell is a pair of chunks, and a row goes to the c cells of its chunk. Work
    in a cell is bounded by 2 * limit rows (about), and no pair is lost. Rows of
    different chunks meet in one cell; those of one chunk count in its ``own`` cell.
    """
    counts = stage(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__lw_n")).where(F.col("__lw_n") > limit), "hot")
    n = counts.count()
    if not n:
        return rows.withColumn("cell", F.lit(0)).withColumn("chunk", F.lit(0)).withColumn("own", F.lit(True))
    dealt = (join_counted(rows, counts, key, n)
             .withColumn("__lw_c", F.expr(f"CAST(coalesce(ceil(__lw_n / {limit}), 1) AS INT)"))
             .withColumn("chunk", F.expr(f"CAST(pmod(xxhash64({member}, 1), __lw_c) AS INT)")))
    cells = F.expr("transform(sequence(0, __lw_c - 1), j -> least(chunk, j) * __lw_c + greatest(chunk, j))")
    return (dealt.withColumn("cell", F.explode(cells)).withColumn("own", F.expr("cell = chunk * __lw_c + chunk"))
            .drop("__lw_n", "__lw_c"))


def over_runs(key: list[str], work: Callable[[pa.Table, np.ndarray], pa.RecordBatch | None], least: int = 200_000):
    """A mapInArrow function over partitions sorted by ``key``: ``work(rows, run starts)`` on whole runs.

    Rows are gathered until about ``least`` of them hold at least one whole run.
    """

    def breaks(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        new[0] = True
        for k in key:
            v = t.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n += batch.num_rows
            if n < least:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            starts = breaks(t)
            last = int(starts[-1])
            if last:
                out = work(t.slice(0, last), starts[:-1])
                if out is not None:
                    yield out
            held = t.slice(last).to_batches()
            n = t.num_rows - last
        if held:
            t = pa.Table.from_batches(held).combine_chunks()
            out = work(t, breaks(t))
            if out is not None:
                yield out

    return run


class Forest:
    """Union by arrays: links join components, whose root is their smallest index."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        p = self.parent
        while True:
            q = p[p]
            if np.array_equal(q, p):
                self.parent = p
                return p
            p = q

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            root = self.roots()
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long) but the roots; the root is the smallest node.

    Alternating large-star and small-star steps by joins and minimum
    aggregates, so a node with many links is pre-aggregated and its join can be
    split; each round is a table in the shared folder.
    """
    e = stage(edges.where("a <> b").selectExpr("greatest(a, b) x", "least(a, b) y").distinct(), "edges")
    mark = None
    while True:
        now = e.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(x, y))").alias("h")).first()
        if (now.n, now.h) == mark or not now.n:
            return e.selectExpr("x node", "y root")
        mark = (now.n, now.h)
        both = e.selectExpr("x n", "y v").unionAll(e.selectExpr("y n", "x v"))
        least = both.groupBy("n").agg(F.least(F.col("n"), F.min("v")).alias("m"))
        large = both.where("v > n").join(least, "n").selectExpr("v x", "m y").distinct()
        small = large.groupBy("x").agg(F.min("y").alias("m"))
        e = stage(large.join(small, "x").where("y <> m").selectExpr("y x", "m y")
                  .unionAll(small.selectExpr("x", "m y")).distinct(), "edges")
