"""Operator 1: token-id files with Elias-Fano encoded document boundaries.

A store is a folder of shard files plus one manifest row per shard. A shard
holds the ids of consecutive documents (ascending doc_id) as one array of
16-bit (or, for larger vocabularies, 32-bit) little-endian ids, followed by two
monotone sequences in Elias-Fano form: the document ids and the documents' end
offsets. An Elias-Fano sequence of n values below u keeps floor(log2(u/n)) low
bits of each value in a packed array and the rest in a bit vector of about 2n
bits; ``select`` finds the i-th set bit from 32-bit positions sampled every
256 set bits. So an offset costs about 2 + log2(tokens per document) bits, and
any one is found without reading the others or a table of 64-bit offsets.

Shard layout: ids | document ids (EF) | end offsets (EF) | trailer of 64 bytes.

Rows and ties. A null text is an empty document (the end id alone). Rows with
a null doc_id come first, in the order of their texts; rows that repeat a
doc_id stay, ordered by text. An empty table gives an empty store. Other
columns of the input are not read.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_folder, ship, stage, text_slices
from .tokens import encoder, vocabulary_path

MAGIC = b"EFTOKS01"
TRAILER = struct.Struct("<8sBxxxIIQqQQ12x")   # magic, width, docs, null ids, ids, first doc_id, section starts
#: Ids per shard file at most (a longer single document still has one shard to itself).
SHARD_IDS = 1 << 26
#: Ids returned in one Arrow batch by the reader.
READ_IDS = 1 << 20
SAMPLE = 256

MANIFEST = "path string, n_docs long, n_null long, n_ids long, first_doc long"


# --- Elias-Fano ----------------------------------------------------------------

class EliasFano:
    """A monotone sequence of non-negative integers, read from its bytes."""

    HEAD = struct.Struct("<QQB7x")

    def __init__(self, raw: bytes | memoryview):
        self.n, self.universe, self.low_bits = self.HEAD.unpack_from(raw, 0)
        at = self.HEAD.size
        low_bytes = (self.n * self.low_bits + 7) // 8
        high_bytes = (self.n + (self.universe >> self.low_bits) + 8) // 8
        n_samples = (self.n + SAMPLE - 1) // SAMPLE
        self.low = np.frombuffer(raw, np.uint8, low_bytes, at)
        self.high = np.frombuffer(raw, np.uint8, high_bytes, at + low_bytes)
        self.samples = np.frombuffer(raw, "<u4", n_samples, at + low_bytes + high_bytes)

    @classmethod
    def encode(cls, values: np.ndarray) -> bytes:
        v = np.asarray(values, np.int64)
        n, universe = len(v), int(v[-1]) if len(v) else 0
        low_bits = max(0, (universe // n).bit_length() - 1) if n else 0
        bits = ((v[:, None] >> np.arange(low_bits)) & 1).astype(np.uint8)
        low = np.packbits(bits.reshape(-1), bitorder="little").tobytes()
        place = (v >> low_bits) + np.arange(n)
        high = np.zeros((n + (universe >> low_bits) + 8) // 8 * 8, np.uint8)
        high[place] = 1
        return (cls.HEAD.pack(n, universe, low_bits) + low
                + np.packbits(high, bitorder="little").tobytes() + place[::SAMPLE].astype("<u4").tobytes())

    def select(self, start: int, stop: int) -> np.ndarray:
        """Values start..stop-1, from the nearest sampled position on."""
        if stop <= start:
            return np.zeros(0, np.int64)
        first = start // SAMPLE
        begin = int(self.samples[first])
        last = (stop - 1) // SAMPLE + 1
        end = int(self.samples[last]) if last < len(self.samples) else len(self.high) * 8
        lo = begin // 8
        ones = np.flatnonzero(np.unpackbits(self.high[lo:end // 8 + 1], bitorder="little")) + lo * 8
        ones = ones[ones >= begin][start - first * SAMPLE:stop - first * SAMPLE]
        values = (ones - np.arange(start, stop)) << self.low_bits
        if self.low_bits:
            b0, b1 = start * self.low_bits, stop * self.low_bits
            bits = np.unpackbits(self.low[b0 // 8:(b1 + 7) // 8], bitorder="little")[b0 % 8:][:b1 - b0]
            values = values | (bits.reshape(-1, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits)))
        return values


# --- writing ---------------------------------------------------------------------

def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class _Shard:
    def __init__(self, folder: str, width: int):
        self.path = f"{folder}/{uuid.uuid4().hex}.ids"
        fs, where = _filesystem(self.path)
        fs.create_dir(where.rsplit("/", 1)[0], recursive=True)
        self.out, self.width = fs.open_output_stream(where), width
        self.docs: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.n_null = self.n_ids = 0

    def add(self, doc_ids: np.ndarray, nulls: int, ids: np.ndarray, counts: np.ndarray) -> None:
        self.out.write(ids.astype("<u2" if self.width == 2 else "<u4").tobytes())
        self.docs.append(doc_ids)
        self.counts.append(counts)
        self.n_null += nulls
        self.n_ids += len(ids)

    def close(self) -> tuple:
        docs, counts = np.concatenate(self.docs), np.concatenate(self.counts)
        first = int(docs[0]) if len(docs) else 0
        keys = EliasFano.encode(docs - first)
        ends = EliasFano.encode(np.cumsum(counts))
        at = self.n_ids * self.width
        self.out.write(keys + ends + TRAILER.pack(MAGIC, self.width, len(counts), self.n_null, self.n_ids,
                                                  first, at, at + len(keys)))
        self.out.close()
        return self.path, len(counts), self.n_null, self.n_ids, first if len(docs) else None


def _write_partition(folder: str, path: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, rows = encoder(path), None, []
        for batch in batches:
            for part, raw, offs in text_slices(batch):
                texts = [raw[a:b].tobytes().decode() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
                ids, counts = enc.encode(texts)
                ids = np.insert(ids, np.cumsum(counts), np.uint32(end_id))
                counts = counts + 1
                keys = part.column("doc_id")
                nulls = keys.null_count   # they come first
                known = keys.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
                if shard is not None and shard.n_ids + len(ids) > shard_ids:
                    rows.append(shard.close())
                    shard = None
                shard = shard or _Shard(folder, enc.width)
                shard.add(known, nulls, ids, counts)
        if shard is not None:
            rows.append(shard.close())
        cols = list(zip(*rows)) if rows else [[]] * 5
        kinds = [pa.string(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)],
                                         ["path", "n_docs", "n_null", "n_ids", "first_doc"])

    return run


def write_token_store(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None,
                      end_id: int = 0, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into a store; returns its manifest (one row per shard).

    One shuffle: the texts by doc_id range. A retried task writes a file of its
    own name; only files named in the manifest belong to the store.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = folder or fresh_folder(spark, "tokens")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranged = keyed.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    run = _write_partition(folder, vocabulary or vocabulary_path(), end_id, shard_ids)
    return stage(ranged.mapInArrow(run, MANIFEST), "token-manifest")


# --- reading ---------------------------------------------------------------------

class ShardReader:
    """Random access to a shard by document index or doc_id."""

    def __init__(self, path: str):
        fs, where = _filesystem(path)
        self.file = fs.open_input_file(where)
        size = self.file.size()
        magic, self.width, self.n_docs, self.n_null, self.n_ids, self.first, keys_at, ends_at = TRAILER.unpack(
            self.file.read_at(TRAILER.size, size - TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"not a token shard: {path}")
        tail = self.file.read_at(size - TRAILER.size - keys_at, keys_at)
        self.keys, self.ends = EliasFano(tail[:ends_at - keys_at]), EliasFano(tail[ends_at - keys_at:])

    def offsets(self, start: int, stop: int) -> np.ndarray:
        """Boundaries start..stop of documents start..stop-1 (one more than documents)."""
        ends = self.ends.select(max(start - 1, 0), stop)
        return ends if start else np.concatenate([[0], ends])

    def doc_ids(self, start: int, stop: int) -> list[int | None]:
        blank = max(0, min(stop, self.n_null) - start)
        known = self.keys.select(max(start - self.n_null, 0), max(stop - self.n_null, 0)) + self.first
        return [None] * blank + known.tolist()

    def ids(self, begin: int, end: int) -> np.ndarray:
        raw = self.file.read_at((end - begin) * self.width, begin * self.width)
        return np.frombuffer(raw, "<u2" if self.width == 2 else "<u4").astype("<u4")

    def find(self, doc_id: int) -> np.ndarray | None:
        """The ids of the first document of this doc_id, by binary search over select."""
        lo, hi = 0, self.keys.n
        while lo < hi:
            mid = (lo + hi) // 2
            if int(self.keys.select(mid, mid + 1)[0]) + self.first < doc_id:
                lo = mid + 1
            else:
                hi = mid
        if lo == self.keys.n or int(self.keys.select(lo, lo + 1)[0]) + self.first != doc_id:
            return None
        a, b = self.offsets(self.n_null + lo, self.n_null + lo + 1)
        return self.ids(int(a), int(b))


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "n_tokens", "ids"]
    for batch in batches:
        for row in batch.to_pylist():
            shard, at = ShardReader(row["path"]), 0
            while at < shard.n_docs:
                bounds = shard.offsets(at, min(at + 4096, shard.n_docs))
                n = max(1, int(np.searchsorted(bounds, bounds[0] + READ_IDS, "right")) - 1)
                bounds = bounds[:n + 1]
                data = shard.ids(int(bounds[0]), int(bounds[-1])).tobytes()
                cuts = ((bounds - bounds[0]) * 4).astype(np.int64)
                body = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids(at, at + n), pa.int64()), pa.array(bounds[:-1] + row["base"]),
                     pa.array(np.diff(bounds)), body.cast(pa.binary())], names)
                at += n


def read_token_store(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids as little-endian 32-bit integers) of every document of a store.

    The manifest has one row per shard of up to ``SHARD_IDS`` ids; its rows are
    put in order on the driver to give each shard the number of ids before it.
    """
    ship(spark)
    shards = sorted(manifest.collect(), key=lambda r: (r.first_doc is not None and not r.n_null,
                                                       r.first_doc if r.first_doc is not None else 0))
    rows, base = [], 0
    for i, r in enumerate(shards):
        rows.append((i, r.path, base))
        base += r.n_ids
    listed = spark.createDataFrame(rows, "i int, path string, base long").repartition(max(1, len(rows)), "i")
    return listed.mapInArrow(_read_shards, "doc_id long, start long, n_tokens long, ids binary")
