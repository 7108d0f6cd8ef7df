"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates.

Words here are maximal runs of letters and digits (bytes above 0x7F count as
letters) and maximal runs of other characters that are not white space, so
``the&&&`` is two words; case is kept. A word equal to the one before it, or to
the one before that, stands as a fixed sign for "same again", so that repetition
itself is a feature. A text's features are its n-grams of 1 to ``ORDER`` such
words, hashed to 2^``BITS`` places; the value of a place is ``GAIN`` times its
share of all the text's n-grams. A text without words has
no features: its score is the model's bias alone.

Learning (``fit``) takes at most ``MAX_ROWS`` labelled documents and
``MAX_GRAMS`` places of them, chosen by a hash of doc_id; a document with
more than ``MAX_GRAMS`` / 64 places is not learned from. Both are limits on
what reaches the driver, whatever the input looks like: a doc_id teaches
once, by that of its texts with the smallest hash. The per-coordinate
updates keep, for each place, the sum ``z`` of adjusted gradients and the sum
``n`` of squared ones; the weight is their closed form with an L1 threshold.

Scoring (``score``) reads every whole text, in parts: the dot product is the
mean of the weights at the n-grams' places, so nothing is sorted or kept.

Odd input: null and empty texts score the bias; rows repeating a doc_id or a
text are scored each; rows without a doc_id are scored, never learned from;
labels other than 0 and 1, null ones, and those of doc_ids whose label rows
disagree teach nothing; with no labels at all every score is 0.5. Only
doc_id and text are read; columns the caller wants to keep are named, and
must not be called ``score`` or ``predicted`` (refused).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from .common import SPACE, mix64, run_hashes, ship, stage
from .textparts import Part, runs_of, text_parts

#: 2^BITS places for n-grams of 1 to ORDER words.
BITS, ORDER = 20, 2
#: What a text's shares are multiplied with.
GAIN = 100.0
#: Most labelled documents, and most places of them, that learning takes.
MAX_ROWS, MAX_GRAMS = 20_000, 8_000_000
#: Rate, its smoothing, L1 and L2 of the updates, passes over the sample, seed of their order.
ALPHA, BETA, L1, L2, PASSES, SEED = 1.0, 1.0, 0.01, 0.1, 8, 17
#: Least score that counts as good.
CUT = 0.3

_KIND = np.full(256, 2, np.uint8)
_KIND[SPACE] = 0
_KIND[0x80:] = 1
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1
_JOIN = np.uint64(0x9E3779B97F4A7C15)
#: What stands for a word seen one place, or two places, before.
_AGAIN = (np.uint64(0xA5A5A5A5A5A5A5A5), np.uint64(0x5A5A5A5A5A5A5A5A))


@dataclass
class Model:
    """Weights of the 2^BITS places and the bias."""
    weights: np.ndarray
    bias: float


def grams(part: Part, before: list) -> tuple[np.ndarray, np.ndarray]:
    """(row within the part, place) of each n-gram that ends in the part.

    ``before`` holds the hashes of the last ORDER + 1 words of the text that
    the part continues, and is brought up to date.
    """
    starts, ends = runs_of(_KIND[part.raw], part.offsets)
    h = run_hashes(part.raw, starts, ends)
    row = np.searchsorted(part.offsets, starts, side="right") - 1
    if not part.follows:
        before.clear()
    kept = len(before)
    h = np.concatenate([np.array(before, np.uint64), h])
    row = np.concatenate([np.zeros(kept, row.dtype), row])
    word = h.copy()
    for back in (2, 1):
        word[back:][(h[back:] == h[:-back]) & (row[back:] == row[:-back])] = _AGAIN[back - 1]
    rows, places, mixed = [row[kept:]], [word[kept:]], word
    for k in range(1, ORDER):
        with np.errstate(over="ignore"):
            mixed = mix64(mixed[:-1] * _JOIN + word[k:])       # the k + 1 words up to each place
        whole = row[k:] == row[:-k]
        whole[:max(kept - k, 0)] = False
        rows.append(row[k:][whole])
        places.append(mixed[whole])
    before[:] = h[-(ORDER + 1):].tolist() if part.rows == 1 else []
    return np.concatenate(rows), (np.concatenate(places) >> np.uint64(64 - BITS)).astype(np.int64)


# --- learning ------------------------------------------------------------------

def _features(batches):
    """(h, doc_id, label, places, values, n) per row of a batch."""
    for batch in batches:
        found: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
        before: list = []
        for part in text_parts(batch.column("text")):
            row, place = grams(part, before)
            order = np.argsort(row, kind="stable")
            for r, p in zip(range(part.rows), np.split(place[order], np.searchsorted(row[order], np.arange(1, part.rows)))):
                found[part.first + r].append(p)
        places, values, sizes = [], [], []
        for f in found:
            at, times = np.unique(np.concatenate(f) if f else np.zeros(0, np.int64), return_counts=True)
            places.append(at.astype("<u4").tobytes())
            values.append((GAIN * times / max(times.sum(), 1)).astype("<f4").tobytes())
            sizes.append(len(at))
        yield pa.record_batch([batch.column("h"), batch.column("doc_id"), batch.column("label"), pa.array(places, pa.binary()),
                               pa.array(values, pa.binary()), pa.array(sizes, pa.int64())],
                              names=["h", "doc_id", "label", "places", "share", "n"])


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> DataFrame:
    """(h, doc_id, label, places, share, n): one row for each chosen labelled doc_id, at most ``max_rows``."""
    told = (labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
            .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
            .where("label = other").select(F.xxhash64(F.lit(SEED), "doc_id").alias("h"), "doc_id", "label"))
    told = stage(told, "labelled")
    n = told.count()
    if n > 2 * max_rows:                # far more than wanted: a hash threshold first, so that the ordering sees few rows
        told = told.where(F.col("h") < int((2 * (2 * max_rows / n) - 1) * 2 ** 63))
    chosen = told.orderBy("h", "doc_id").limit(max_rows)         # at most max_rows rows of three numbers
    texts = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
             .groupBy("h", "doc_id", "label").agg(F.expr("min_by(text, xxhash64(text))").alias("text")))
    ship(docs.sparkSession)
    return stage(texts.mapInArrow(_features, "h long, doc_id long, label int, places binary, share binary, n long"),
                 "ngram-features")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS,
        max_grams: int = MAX_GRAMS) -> Model:
    """The model learned from the rows of ``labels`` (doc_id, 0/1) on the texts of ``docs``."""
    rows = training_rows(docs, labels, label, max_rows).where(F.col("n") <= max_grams // 64)
    sizes = rows.select("h", "doc_id", "n").orderBy("h", "doc_id").toArrow()           # at most max_rows rows
    if sizes.num_rows == 0:
        return Model(np.zeros(1 << BITS, np.float32), 0.0)
    fits = int(np.searchsorted(np.cumsum(sizes["n"].to_numpy()), max_grams, side="right"))
    last = sizes.slice(fits - 1, 1).to_pylist()[0]
    sample = rows.where((F.col("h") < last["h"]) | (F.col("h") == last["h"]) & (F.col("doc_id") <= last["doc_id"]))
    got = sample.select("h", "doc_id", "label", "places", "share").toArrow().sort_by([("h", "ascending"), ("doc_id", "ascending")])
    return train([(np.frombuffer(p, "<u4").astype(np.int64), np.frombuffer(v, "<f4").astype(np.float64))
                  for p, v in zip(got["places"].to_pylist(), got["share"].to_pylist())], got["label"].to_numpy())


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, passes: int = PASSES, seed: int = SEED) -> Model:
    """Follow-the-regularised-leader over (places, values) rows, one at a time, in a seeded order per pass."""
    bias_at = 1 << BITS
    z, n = np.zeros(bias_at + 1), np.zeros(bias_at + 1)
    threshold = np.full(bias_at + 1, L1)
    threshold[bias_at] = 0.0                                     # the bias is not thinned out
    rng = np.random.default_rng(seed)
    rows = [(np.append(at, bias_at), np.append(x, 1.0)) for at, x in rows]
    for _ in range(passes):
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            zi, ni = z[at], n[at]
            w = _weights(zi, ni, threshold[at])
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - labels[i]) * x
            grown = ni + g * g
            z[at] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / ALPHA * w
            n[at] = grown
    w = _weights(z, n, threshold)
    return Model(w[:bias_at].astype(np.float32), float(w[bias_at]))


def _weights(z, n, threshold):
    """The minimiser of the regularised sum of the losses' linear bounds."""
    return -np.sign(z) * np.maximum(np.abs(z) - threshold, 0.0) / ((BETA + np.sqrt(n)) / ALPHA + L2)


# --- scoring -------------------------------------------------------------------

def margins(column: pa.Array, model: Model) -> np.ndarray:
    """The linear score of each text of the column."""
    total, count = np.zeros(len(column)), np.zeros(len(column), np.int64)
    before: list = []
    for part in text_parts(column):
        row, place = grams(part, before)
        here = slice(part.first, part.first + part.rows)
        total[here] += np.bincount(row, model.weights[place], part.rows)
        count[here] += np.bincount(row, minlength=part.rows)
    return model.bias + GAIN * total / np.maximum(count, 1)


def score(docs: DataFrame, model: Model, keep: list[str], cut: float = CUT) -> DataFrame:
    """The columns ``keep`` of each row, with ``score`` (0 to 1) and ``predicted`` (1 from ``cut`` on)."""
    clash = {"score", "predicted"} & {k.lower() for k in keep}
    if clash:
        raise ValueError(f"columns to keep are named like results: {sorted(clash)}")
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)                 # 2^BITS numbers, whatever the corpus

    def judge(batches):
        for batch in batches:
            p = 1.0 / (1.0 + np.exp(-np.clip(margins(batch.column(batch.num_columns - 1), shared.value), -35, 35)))
            yield pa.record_batch([*(batch.column(i) for i in range(len(keep))), pa.array(p, pa.float64()),
                                   pa.array((p >= cut).astype(np.int32))], names=[*keep, "score", "predicted"])

    kept = docs.select(*keep, F.col("text").alias("__lw_text"))
    out = StructType([*kept.schema.fields[:-1]]).add("score", DoubleType()).add("predicted", IntegerType())
    return kept.mapInArrow(judge, out)
