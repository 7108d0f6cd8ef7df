"""Operator 6: language identification in two steps, family first.

A text becomes a vector of hashed character 1- to 3-grams (lower case; whatever
is not a letter counts as one word end), with logarithmic counts and length
one. One-versus-one linear support vector machines vote for the language
family, then those of the languages within that family vote for the language.
Ties of votes go to the larger sum of margins, then to the smaller name.

Training uses a bounded sample: about ``max_rows`` labelled rows in all, the
same number for each language, chosen by a hash of doc_id; only their vectors
of ``DIM`` numbers come to the driver.

Rows and ties. A null text or one without a letter is ``und`` with score 0;
without training rows every text is. With one language everything is that
language, score 1. Repeated rows are predicted each. Empty tables give empty
results. Other columns pass only if named in ``keep``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix64, ship, slices

DIM = 4096
MAX_ROWS = 2400
#: Most languages learned, those of the most rows: bounds the model, which has a machine for each pair.
MAX_LANGUAGES = 64
EPOCHS, COST = 12, 4.0
UNDETERMINED = "und"

#: Families of ISO 639 codes (fixed values); a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
    "baltic": ["lt", "lv"],
}


def family_of(lang: str) -> str:
    code = lang.lower().split("-")[0].split("_")[0]
    return next((f for f, codes in FAMILIES.items() if code in codes), f"~{lang}")


_LETTERS = np.zeros(0, bool)


def _letters() -> np.ndarray:
    global _LETTERS
    if not len(_LETTERS):
        _LETTERS = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTERS


def vectors(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(a row of DIM numbers for each text, whether it has a letter)."""
    n = len(texts)
    lowered = [np.frombuffer((t or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    sizes = np.array([len(x) + 1 for x in lowered], np.int64)
    stop = np.zeros(1, np.uint32)
    flat = np.concatenate([part for x in lowered for part in (x, stop)]) if n else np.zeros(0, np.uint32)
    doc = np.repeat(np.arange(n), sizes)
    letter = _letters()[flat]
    has = np.bincount(doc[letter], minlength=n) > 0
    c = np.where(letter, flat, 0).astype(np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]          # one end mark after a word; it also starts the next
    keep &= letter | np.concatenate([[False], letter[:-1]])
    c, doc = c[keep], doc[keep]
    out = np.zeros((n, DIM), np.float32)
    if len(c):
        total = np.zeros(n * DIM, np.float64)
        with np.errstate(over="ignore"):
            key = np.zeros(len(c), np.uint64)
            for size in (1, 2, 3):
                m = len(c) - size + 1
                if m <= 0:
                    break
                key = (key[:m] * np.uint64(0x110000)) + c[size - 1:]
                same = doc[:m] == doc[size - 1:]
                slot = (mix64(key + np.uint64(size) * np.uint64(0x5BD1E995)) % np.uint64(DIM)).astype(np.int64)
                total += np.bincount(doc[:m][same] * DIM + slot[same], minlength=n * DIM)
        out = np.log1p(total).reshape(n, DIM).astype(np.float32)
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        out /= np.where(norm > 0, norm, 1)
    return out, has


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = COST, epochs: int = EPOCHS, seed: int = 7) -> np.ndarray:
    """Weights (with a bias as last) of a linear SVM with squared hinge loss, by dual coordinate descent."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    diagonal = 0.5 / cost
    q = np.einsum("ij,ij->i", x, x) + diagonal
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(x)):
            grad = y[i] * (x[i] @ w) - 1 + diagonal * alpha[i]
            new = max(alpha[i] - grad / q[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


class Voters:
    """One-versus-one machines over some classes."""

    def __init__(self, classes: list[str], x: np.ndarray, labels: np.ndarray):
        self.classes = sorted(classes)
        self.pairs = list(combinations(range(len(self.classes)), 2))
        rows = []
        for i, j in self.pairs:
            a, b = labels == self.classes[i], labels == self.classes[j]
            part = np.flatnonzero(a | b)
            rows.append(fit_svm(x[part], np.where(a[part], 1.0, -1.0)))
        self.weights = np.array(rows).reshape(len(rows), x.shape[1] + 1).astype(np.float32)

    def vote(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the class, confidence from 0 to 1) of each row."""
        n, k = len(x), len(self.classes)
        if k == 1:
            return np.zeros(n, np.int64), np.ones(n)
        margin = x @ self.weights[:, :-1].T + self.weights[:, -1]
        votes, sums = np.zeros((n, k)), np.zeros((n, k))
        for p, (i, j) in enumerate(self.pairs):
            m = margin[:, p]
            votes[:, i] += m >= 0
            votes[:, j] += m < 0
            sums[:, i] += m
            sums[:, j] -= m
        best = np.lexsort((-np.arange(k) + np.zeros((n, 1)), sums, votes), axis=1)[:, -1]
        least = np.full(n, np.inf)
        for p, (i, j) in enumerate(self.pairs):
            least = np.where(best == i, np.minimum(least, margin[:, p]), least)
            least = np.where(best == j, np.minimum(least, -margin[:, p]), least)
        return best, 1 / (1 + np.exp(-4 * np.clip(least, -20, 20)))


class Model:
    """Family voters and, in each family, language voters."""

    def __init__(self, x: np.ndarray, labels: list[str]):
        langs = np.array(labels, object)
        families = np.array([family_of(v) for v in labels], object)
        self.family = Voters(sorted(set(families)), x, families) if len(labels) else None
        self.within = {f: Voters(sorted(set(langs[families == f])), x[families == f], langs[families == f])
                       for f in sorted(set(families))}

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        x, has = vectors(texts)
        names, score = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
        if self.family is None:
            return names.tolist(), score
        family, sure = self.family.vote(x)
        for i, f in enumerate(self.family.classes):
            at = np.flatnonzero(has & (family == i))
            if len(at):
                lang, c = self.within[f].vote(x[at])
                names[at] = np.array(self.within[f].classes, object)[lang]
                score[at] = sure[at] * c
        return names.tolist(), score


def _vector_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in _text_parts(batch):
            x, has = vectors(texts)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("lang"),
                 pa.array([v.tobytes() if h else None for v, h in zip(x, has)], pa.binary())],
                ["doc_id", "lang", "v"])


def _text_parts(batch: pa.RecordBatch, column: str = "text"):
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    for a, b in slices(sizes, 1_000_000):
        part = batch.slice(a, b - a)
        for c in range(0, part.num_rows, 384):      # bounds the rows of DIM numbers
            piece = part.slice(c, 384)
            yield piece, piece.column(column).to_pylist()


def fit(rows: DataFrame, max_rows: int = MAX_ROWS, seed: int = 17, max_languages: int = MAX_LANGUAGES) -> Model:
    """A model from labelled ``rows`` (doc_id, text, lang); rows without a lang are ignored.

    The ``max_languages`` languages of the most rows are learned (ties: the
    smaller name). A language has at most max_rows / languages rows in the
    sample: those of the smallest hashes of doc_id and text, so many rows of
    one doc_id (or of none) are sampled like others, and equal rows are one.
    A hash threshold leaves some twice as many before they are ordered.
    """
    ship(rows.sparkSession)
    h = F.xxhash64(F.col("doc_id").cast("long"), "text", F.lit(seed))
    rows = rows.where("lang IS NOT NULL").select(h.alias("h"), F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    counted = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("h").alias("apart"))
    totals = {r.lang: r.apart for r in counted.orderBy(F.desc("n"), "lang").limit(max_languages).collect()}
    if not totals:
        return Model(np.zeros((0, DIM), np.float32), [])
    share = max(1, max_rows // len(totals))
    wanted = F.lit(False)
    for lang, n in totals.items():
        limit = (1 << 30) if n <= 2 * share else int((1 << 30) * 2 * share / n)
        wanted = wanted | ((F.col("lang") == F.lit(lang)) & (F.pmod("h", F.lit(1 << 30)) < limit))
    near = rows.where(wanted).groupBy("lang", "h").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
    chosen = (near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
              .where(F.col("rank") <= share))
    got = chosen.mapInArrow(_vector_rows, "doc_id long, lang string, v binary").where("v IS NOT NULL").collect()
    got = sorted(got, key=lambda r: (r.lang, zlib.crc32(r.v), r.doc_id if r.doc_id is not None else -1))
    x = np.stack([np.frombuffer(r.v, np.float32) for r in got]) if got else np.zeros((0, DIM), np.float32)
    return Model(x, [r.lang for r in got])


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row, lang_pred and score; no shuffle. Columns to keep of these names are refused."""
    clash = {"lang_pred", "score"} & {k.lower() for k in keep}
    if clash:
        raise ValueError(f"columns to keep are named like results: {sorted(clash)}")
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)     # DIM numbers a pair of families or relatives, MAX_LANGUAGES at most
    src = docs.select(*keep, F.col("text").alias("__lw_text"))
    fields = [f for f in src.schema.fields if f.name != "__lw_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part, texts in _text_parts(batch, "__lw_text"):
                names, score = m.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(f.name) for f in fields] + [pa.array(names, pa.string()), pa.array(score)],
                    [f.name for f in fields] + ["lang_pred", "score"])

    return src.mapInArrow(run, T.StructType([*fields, T.StructField("lang_pred", T.StringType()),
                                             T.StructField("score", T.DoubleType())]))
