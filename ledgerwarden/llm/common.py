"""Shared helpers: package shipping, staging in the shared folder, slicing, byte-level words.

The numpy helpers work on the UTF-8 bytes of a slice of texts at a time, so a
task never holds more than one slice besides its Arrow batch.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

#: Bytes of text handled at once inside a task; a longer text is a slice of its own.
SLICE_BYTES = 1_000_000

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application (a no-op where it is installed too)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="llm-ship-"), f"{root.name}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder under the shared checkpoint directory."""
    return scratch_path(spark, "llm", f"{label}-{uuid.uuid4().hex}")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(lengths: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges whose lengths sum to at most ``limit`` (one row at least)."""
    n, start, total = len(lengths), 0, 0
    for i in range(n):
        size = int(lengths[i])
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if n > start:
        yield start, n


def text_slices(batch: pa.RecordBatch, column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, UTF-8 bytes, offsets) per slice; a null text has no bytes."""
    col = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    for a, b in slices(sizes, limit):
        rows = batch.slice(a, b - a)
        flat = pc.fill_null(rows.column(column), "").cast(pa.large_string())
        yield rows, *string_bytes(flat)


def string_bytes(col: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large_string array without nulls, and its n + 1 offsets into them."""
    _, offs, data = col.buffers()
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    o = np.frombuffer(offs, np.int64, n + 1, col.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[o[0]:o[-1]], (o - o[0]).astype(np.int64)


# --- hashing of byte runs ----------------------------------------------------

def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix); distinct inputs give distinct outputs."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_MULTIPLIERS = np.zeros(0, np.uint64)


def multipliers(n: int, seed: int = 0) -> np.ndarray:
    """n odd 64-bit multipliers, one for each position."""
    global _MULTIPLIERS
    if seed:
        return mix64(np.arange(n, dtype=np.uint64) + np.uint64(seed) * np.uint64(1_000_003)) | np.uint64(1)
    if len(_MULTIPLIERS) < n:
        _MULTIPLIERS = mix64(np.arange(max(n, 4096), dtype=np.uint64)) | np.uint64(1)
    return _MULTIPLIERS[:n]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run values[start:end] (runs in order, apart, none empty)."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    total = int(sizes.sum())
    first = np.cumsum(sizes) - sizes
    inside = np.arange(total, dtype=np.int64) - np.repeat(first, sizes)
    at = inside + np.repeat(starts, sizes)
    m = multipliers(int(sizes.max()))
    with np.errstate(over="ignore"):
        terms = (values[at].astype(np.uint64) + np.uint64(1)) * m[inside]
        return mix64(np.add.reduceat(terms, first) + sizes.astype(np.uint64))


#: The word separators of every contract here: space and U+0009 to U+000D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges (starts, ends) of the words; a word never crosses one of ``offsets``."""
    if len(raw) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~SPACE[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets[:-1]] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | cut[1:len(raw)]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:] | cut[1:len(raw)]
    return np.flatnonzero(begin), np.flatnonzero(finish) + 1


def large(values, kind) -> pa.Array:
    return pa.array(values, kind)
