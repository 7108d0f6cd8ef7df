"""Operator 5: quality rules whose cutoffs carry a statistical guarantee.

Each rule rejects a document whose score reaches the rule's cutoff for the
document's stratum (its ``lang``; a null lang is a stratum of its own). The
cutoffs are learnt from labelled documents, in two families of fixed sequences:

* Rule by rule: the cutoffs of a rule's fixed grid from the most lenient on,
  each tested against the share alpha / rules.
* Jointly: sets of cutoffs for all rules, each set stricter than the last, tested
  against the whole alpha. There is a sequence for each rule, which takes that
  rule's cutoffs first and then, one at a time, the cutoff that catches the most
  labelled bad documents not caught yet. Its order comes from the bad documents
  alone, so it is fixed as far as the good holdouts are concerned.

Testing at share a means testing "more than a of the good documents are
rejected" with the exact binomial tail P(Bin(n, a) <= k), where k of the n good
holdouts are. A sequence stops at the first test that is not certified at
delta / (2 * strata * rules). Fixed-sequence testing inside a sequence and the
Bonferroni division over strata, families and rules keep the chance that any
stratum loses more than ``alpha`` of its good documents below ``delta``. Of what
is certified the best balance of labelled bad documents caught against good
ones lost is used (ties: rule by rule, the lenient one); where nothing is
certified or catches anything, the rules stay off in that stratum.

Least count. With no good holdout rejected, a stratum needs 134 of them (that
pass the base test) before any rule can switch on where there are 4 strata, 107
with one stratum, 150 with nine (``least_holdouts``). Smaller strata keep every
bad document that passes the base test.

Rows and ties. A null text has no words and fails the base test. A document
with several labels is good only if all its non-null labels are 1; labels of
unknown documents are ignored. Repeated doc_ids are judged row by row. Without
labels only the base test holds. Empty tables give empty results. Columns of
``docs`` other than those read pass through untouched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, mix64, multipliers, run_hashes, ship, text_slices, words_of

ALPHA, DELTA = 0.05, 0.05
#: Good documents lost weigh this much against bad ones caught when a certified cutoff is chosen.
LOSS_WEIGHT = 20.0
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_letters", "n_upper", "n_bangs", "n_adjacent"]

#: Score of each rule (numerator, denominator) and its grid of cutoffs, lenient first.
RULES: dict[str, tuple[str, str, list[float]]] = {
    "symbols": ("n_symbols", "word_chars", [0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02, 0.01]),
    "capitals": ("n_upper", "n_letters", [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15]),
    "bangs": ("n_bangs", "n_words", [2.0, 1.5, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1, 0.05]),
    "repeats": ("n_repeat_words", "n_words", [0.3, 0.28, 0.25, 0.22, 0.2, 0.17, 0.15, 0.12, 0.1]),
    "adjacent": ("n_adjacent", "n_words", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05]),
    "dup_lines": ("n_dup_lines", "n_lines", [0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3]),
}

SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point, whether it is a letter and whether it is a capital one (Unicode, all scripts)."""
    letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    upper = np.fromiter((chr(i).isupper() for i in range(0x110000)), bool, 0x110000)
    return letter, letter & upper


def _code_points(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of the texts and their offsets into them (bytes that are no UTF-8 count as U+FFFD)."""
    texts = [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return flat, np.cumsum([0, *map(len, texts)])


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(upto[offsets])


def _repeated_words(hashes: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Words of each document inside a WINDOW-word window that it holds twice or more."""
    n = len(hashes)
    if n < WINDOW:
        return np.zeros(n_docs, np.int64)
    m = multipliers(WINDOW, seed=11)
    with np.errstate(over="ignore"):
        key = np.zeros(n - WINDOW + 1, np.uint64)
        for j in range(WINDOW):
            key += hashes[j:n - WINDOW + 1 + j] * m[j]
        key = mix64(key + doc[:n - WINDOW + 1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    whole = np.flatnonzero(doc[:n - WINDOW + 1] == doc[WINDOW - 1:])
    key = key[whole]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = whole[twice]
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + WINDOW, -1)
    covered = np.cumsum(change[:-1]) > 0
    return np.bincount(doc[covered], minlength=n_docs).astype(np.int64)


def count_text(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The COUNTS of each text of a slice (UTF-8 bytes and offsets)."""
    n_docs = len(offsets) - 1
    starts, ends = words_of(raw, offsets)
    doc = np.searchsorted(offsets[1:], starts, "right")
    hashes = run_hashes(raw, starts, ends)
    lead = (raw & 0xC0) != 0x80
    out = {"n_words": np.bincount(doc, minlength=n_docs).astype(np.int64),
           "word_chars": _sums(lead & ~SPACE[raw], offsets),
           "n_symbols": _sums(SYMBOL[raw], offsets),
           "n_bangs": _sums(raw == ord("!"), offsets)}
    points, at = _code_points(raw, offsets)
    letter, upper = _letters()
    out["n_letters"], out["n_upper"] = _sums(letter[points], at), _sums(upper[points], at)
    repeat = np.zeros(len(hashes), bool)
    if len(hashes) > 1:
        repeat[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    out["n_adjacent"] = np.bincount(doc[repeat], minlength=n_docs).astype(np.int64)
    out["n_repeat_words"] = _repeated_words(hashes, doc, n_docs)
    # lines that hold a word: cut at line ends and text ends, keep those where a word starts
    cuts = np.unique(np.concatenate([np.flatnonzero(raw == 10) + 1, offsets]))
    line = np.unique(np.searchsorted(cuts, starts, "right")) - 1
    a, b = cuts[line], cuts[line + 1]
    b = b - (raw[b - 1] == 10) if len(b) else b
    line_doc = np.searchsorted(offsets[1:], a, "right")
    with np.errstate(over="ignore"):
        key = run_hashes(raw, a, b) + mix64(line_doc.astype(np.uint64))
    out["n_lines"] = np.bincount(line_doc, minlength=n_docs).astype(np.int64)
    _, first = np.unique(key, return_index=True)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(line_doc[first], minlength=n_docs)
    return out


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, raw, offs in text_slices(batch, "__lw_text"):
            counts = count_text(raw, offs)
            keep = [i for i, name in enumerate(part.schema.names) if name != "__lw_text"]
            yield pa.RecordBatch.from_arrays(
                [part.column(i) for i in keep] + [pa.array(counts[c], pa.int64()) for c in COUNTS],
                [part.schema.names[i] for i in keep] + [f"__lw_{c}" for c in COUNTS])


def with_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` and its text's COUNTS as ``__lw_`` columns; no shuffle."""
    ship(docs.sparkSession)
    src = docs.select(*keep, F.col("text").alias("__lw_text"))
    fields = [f for f in src.schema.fields if f.name != "__lw_text"]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields]
                          + [T.StructField(f"__lw_{c}", T.LongType()) for c in COUNTS])
    return src.mapInArrow(_count_batches, schema)


def base_failed() -> Column:
    return F.expr(f"__lw_n_words < {MIN_WORDS} OR 100 * __lw_n_repeat_words > {MAX_REPEAT_PERCENT} * __lw_n_words")


def _score(rule: str) -> str:
    top, bottom, _ = RULES[rule]
    return f"coalesce(try_divide(CAST(__lw_{top} AS DOUBLE), __lw_{bottom}), 0D)"


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), exact up to rounding."""
    if k >= n or p <= 0:
        return 1.0
    if p >= 1:
        return 0.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
            + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def certified(reach: list[int], n: int, alpha: float, level: float) -> int:
    """How many cutoffs, lenient first, are certified; reach[i] of n good holdouts reach cutoff i."""
    for i, k in enumerate(reach):
        # the tail is at least its value at 0, and beyond the mean it is never small
        if k > alpha * n or binomial_tail(k, n, alpha) > level:
            return i
    return len(reach)


def least_holdouts(strata: int, alpha: float = ALPHA, delta: float = DELTA) -> int:
    """Good holdouts, none of them rejected, from which a stratum can have a rule."""
    return math.ceil(math.log(delta / (2 * strata * len(RULES))) / math.log1p(-alpha))


class Places:
    """Labelled documents of a stratum: rows of grid places reached, one column for each rule, and their counts."""

    def __init__(self, rows: list[tuple[list[int], int]]):
        self.at = np.array([r[0] for r in rows], np.int64).reshape(len(rows), len(RULES))
        self.n = np.array([r[1] for r in rows], np.int64)
        self.total = int(self.n.sum())

    def hit(self, need: list[int]) -> np.ndarray:
        """Rows that reach the place ``need`` of some rule."""
        return (self.at >= np.array(need)).any(axis=1)

    def caught(self, need: list[int]) -> int:
        return int(self.n[self.hit(need)].sum())


def joint_sequence(bad: Places, lead: int) -> list[list[int]]:
    """Places needed of each rule, stricter from step to step; every step catches further bad documents.

    The rule ``lead`` takes its steps first; then the rule whose next such
    place catches the most (ties: the earlier rule).
    """
    need = [len(grid) + 1 for _, _, grid in RULES.values()]      # more places than there are: off
    steps = []
    while True:
        left = ~bad.hit(need)
        options = []
        for r in range(len(RULES)):
            reached = bad.at[left, r]
            if reached.any():
                place = int(reached.max())
                options.append((r != lead, -int(bad.n[left][reached == place].sum()), r, place))
        if not options:
            return steps
        _, _, r, place = min(options)
        need = [place if i == r else x for i, x in enumerate(need)]
        steps.append(need)


def fit_cutoffs(counts: DataFrame, labels: DataFrame, alpha: float = ALPHA,
                delta: float = DELTA) -> dict[str | None, dict[str, float]]:
    """Cutoffs by stratum and rule from ``counts`` (doc_id, lang, COUNTS) and ``labels`` (doc_id, quality).

    Joins the counts only (no text). A labelled doc_id is one holdout, however many rows repeat it: that of the
    greatest stratum (null least) and places. What comes to the driver has a row for each
    stratum, label and combination of grid places that a labelled document has.
    """
    verdicts = (labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
                .agg(F.min("quality").alias("__lw_good")))
    known = counts.where(~base_failed()).join(verdicts, "doc_id")
    places = []
    for rule, (_, _, grid) in RULES.items():
        reached = " + ".join(f"CAST(s >= {c}D AS INT)" for c in grid)
        places.append(reached.replace("s >=", _score(rule) + " >="))
    once = (known.select("doc_id", (F.col("__lw_good") >= 1).alias("good"),
                         F.struct(F.col("lang").alias("stratum"), F.expr(f"array({', '.join(places)})").alias("places")).alias("at"))
            .groupBy("doc_id", "good").agg(F.max("at").alias("at")))         # rows repeating an id are one holdout
    rows = once.groupBy("at.stratum", "good", "at.places").count().collect()
    strata = sorted({r.stratum for r in rows}, key=lambda s: (s is not None, s or ""))
    level = delta / max(1, 2 * len(strata) * len(RULES))
    grids = [grid for _, _, grid in RULES.values()]
    off = [len(grid) + 1 for grid in grids]
    found: dict[str | None, dict[str, float]] = {}
    for s in strata:
        good, bad = (Places([(r.places, r["count"]) for r in rows if r.stratum == s and bool(r.good) == g])
                     for g in (True, False))

        def gain(need: list[int]) -> float:
            return bad.caught(need) / max(1, bad.total) - LOSS_WEIGHT * good.caught(need) / max(1, good.total)

        chosen = list(off)
        for r, grid in enumerate(grids):
            # place n - i of n: a score that reaches cutoff i reaches every stricter one after it
            steps = [[len(grid) - i if x == r else y for x, y in enumerate(off)] for i in range(len(grid))]
            usable = certified([good.caught(x) for x in steps], good.total, alpha / len(RULES), level)
            best = 0.0
            for x in steps[:usable]:
                if gain(x) > best + 1e-12:
                    best, chosen[r] = gain(x), x[r]
        best = gain(chosen)
        for lead in range(len(RULES)):
            steps = joint_sequence(bad, lead)
            for x in steps[:certified([good.caught(x) for x in steps], good.total, alpha, level)]:
                if gain(x) > best + 1e-12:
                    best, chosen = gain(x), x
        cutoffs = {rule: grid[len(grid) - p] for rule, grid, p in zip(RULES, grids, chosen) if p <= len(grid)}
        if cutoffs:
            found[s] = cutoffs
    return found


def kept(cutoffs: dict[str | None, dict[str, float]], stratum: str = "lang") -> Column:
    """True where the base test and every rule of the row's stratum let it pass."""
    reject = F.lit(False)
    for s, rules in cutoffs.items():
        hit = F.lit(False)
        for rule, c in rules.items():
            hit = hit | F.expr(f"{_score(rule)} >= {c}D")
        reject = reject | (F.col(stratum).eqNullSafe(F.lit(s)) & hit)
    return ~base_failed() & ~reject


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
          staged=None) -> DataFrame:
    """doc_id, lang, the COUNTS (``__lw_`` columns), base_failed and kept of every row."""
    counts = with_counts(docs, ["doc_id", "lang"])
    counts = staged(counts) if staged else counts
    cutoffs = fit_cutoffs(counts, labels, alpha, delta)
    return counts.withColumn("base_failed", base_failed()).withColumn("kept", kept(cutoffs))


def filter_documents(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they were.

    The texts are read twice (cutoffs, then the verdict), never shuffled.
    """
    cutoffs = fit_cutoffs(with_counts(docs, ["doc_id", "lang"]), labels, alpha, delta)
    names = docs.columns
    judged = with_counts(docs, names)
    return judged.where(kept(cutoffs)).select(*names)
