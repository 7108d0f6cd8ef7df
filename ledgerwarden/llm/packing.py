"""Operator 7: packing token pieces into windows by Karmarkar-Karp multiway differencing.

``difference`` partitions weights into k bins: every weight starts as a
partial partition of its own; the two partial partitions with the largest
imbalance are merged, the fullest bins of one with the emptiest of the other,
until one is left. Its bins are near equal. ``windows`` calls it with the
least window count that could hold the weights and raises the count whenever a
bin exceeds the capacity.

``pack_documents`` turns texts into ids, cuts full windows of ``capacity`` ids
off each document, cuts the rest into pieces of ``piece`` ids at most and
packs the pieces of ``group`` windows at a time. The cut that closes a group
leaves ``reserve`` free ids per window, so that the near-equal bins fit. All
work is inside the tasks that read the texts: no shuffle, and the memory of a
task is one slice of texts and one group.

Rows and ties. A null text is an empty document: the end id alone. Repeated
rows and repeated doc_ids are packed each; a null doc_id stays null. An empty
table gives no pieces. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ship, text_slices
from .tokens import encoder, vocabulary_path

CAPACITY = 1024
#: With these, bins of a full group differ by about 8 ids, so the least count mostly fits at once.
PIECE = 256
GROUP = 96
RESERVE = 8

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long, sequence_length long")


def difference(weights: np.ndarray, k: int) -> list[list[int]]:
    """k bins of indexes into ``weights`` with near-equal sums (multiway differencing).

    Ties go to the lower index. Bins may be empty when there are fewer weights than bins.
    """
    n = len(weights)
    if n == 0 or k < 1:
        return [[] for _ in range(max(k, 0))]
    if k == 1:
        return [list(range(n))]
    left, right = [], []                       # merged bins: node n + i joins left[i] and right[i]
    heap: list[tuple] = []
    for i in range(n):
        heap.append((-int(weights[i]), i, None, i))
    heapq.heapify(heap)
    serial = n

    def dense(item):
        if item[2] is not None:
            return item[2], item[3]
        sums, nodes = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[0], nodes[0] = -item[0], item[3]
        return sums, nodes

    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        if b[2] is not None and a[2] is None:
            a, b = b, a
        sums, nodes = dense(a)
        if b[2] is None:                       # one bin: it goes to the emptiest of a
            w, node = -b[0], b[3]
            total = int(sums[-1]) + w
            if nodes[-1] >= 0:
                left.append(int(nodes[-1]))
                right.append(node)
                node = n + len(left) - 1
            at = int(np.searchsorted(-sums[:-1], -total, "right"))
            sums = np.concatenate([sums[:at], [total], sums[at:-1]])
            nodes = np.concatenate([nodes[:at], [node], nodes[at:-1]])
        else:
            other_sums, other = b[2][::-1], b[3][::-1]
            sums = sums + other_sums
            both = np.flatnonzero((nodes >= 0) & (other >= 0))
            merged = np.where(nodes >= 0, nodes, other)
            merged[both] = n + len(left) + np.arange(len(both))
            left.extend(nodes[both].tolist())
            right.extend(other[both].tolist())
            order = np.argsort(-sums, kind="stable")
            sums, nodes = sums[order], merged[order]
        serial += 1
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), serial, sums, nodes))
    _, nodes = dense(heap[0])
    bins = []
    for root in nodes.tolist():
        items, todo = [], [root] if root >= 0 else []
        while todo:
            x = todo.pop()
            if x < n:
                items.append(x)
            else:
                todo += [right[x - n], left[x - n]]
        bins.append(sorted(items))
    return bins


def windows(weights: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of near-equal sums of at most ``capacity``; the count rises while one exceeds it."""
    weights = np.asarray(weights, np.int64)
    if len(weights) and int(weights.max()) > capacity:
        raise ValueError("a weight exceeds the capacity; cut it first")
    k = -(-int(weights.sum()) // capacity)
    while True:
        bins = difference(weights, k)
        if all(int(weights[b].sum()) <= capacity for b in bins):
            return [b for b in bins if b]
        k += 1


class _Packer:
    """Pieces of one task, packed group by group; sequence ids follow (task, order)."""

    def __init__(self, task: int, capacity: int, piece: int, group: int, reserve: int):
        self.capacity, self.piece = capacity, piece
        self.room = self.target = group * (capacity - reserve)
        self.next_id = task << 40
        self.waiting: list[tuple] = []      # (doc_id, start, ids, doc_tokens)
        self.rows: list[tuple] = []
        self.bytes = 0

    def _emit(self, pieces: list[tuple]) -> None:
        offset, length = 0, sum(len(p[2]) for p in pieces)
        for doc, start, ids, doc_tokens in pieces:
            raw = ids.astype("<u4").tobytes()
            self.rows.append((doc, start, len(ids), raw, doc_tokens, self.next_id, offset, length))
            offset += len(ids)
            self.bytes += len(raw) + 64
        self.next_id += 1

    def add(self, doc, ids: np.ndarray) -> None:
        n, c = len(ids), self.capacity
        full = n // c * c
        for a in range(0, full, c):
            self._emit([(doc, a, ids[a:a + c], n)])
        at = full
        while at < n:
            size = min(self.piece, n - at, self.room)
            self.waiting.append((doc, at, ids[at:at + size].copy(), n))
            at += size
            self.room -= size
            if not self.room:
                self.close()

    def close(self) -> None:
        if self.waiting:
            for members in windows(np.array([len(p[2]) for p in self.waiting]), self.capacity):
                self._emit([self.waiting[i] for i in members])
        self.waiting, self.room = [], self.target

    def batch(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows)) if self.rows else [[]] * 8
        self.rows, self.bytes = [], 0
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_length"]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names)


def _pack_partition(path: str, end_id: int, capacity: int, piece: int, group: int, reserve: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = encoder(path)
        packer = _Packer(TaskContext.get().partitionId(), capacity, piece, group, reserve)
        for batch in batches:
            for part, raw, offs in text_slices(batch):
                texts = [raw[a:b].tobytes().decode() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
                ids, counts = enc.encode(texts)
                ids = np.insert(ids, np.cumsum(counts), np.uint32(end_id))
                ends = np.cumsum(counts + 1)
                for doc, a, b in zip(part.column("doc_id").to_pylist(), (ends - counts - 1).tolist(), ends.tolist()):
                    packer.add(doc, ids[a:b])
                    if packer.bytes > 4_000_000:
                        yield packer.batch()
        packer.close()
        yield packer.batch()

    return run


def pack_documents(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0, capacity: int = CAPACITY,
                   piece: int = PIECE, group: int = GROUP, reserve: int = RESERVE) -> DataFrame:
    """One row per piece: its ids, its place in its document, its sequence and its offset there."""
    spark = docs.sparkSession
    ship(spark)
    run = _pack_partition(vocabulary or vocabulary_path(), end_id, capacity, piece, group, reserve)
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)
