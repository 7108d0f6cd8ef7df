"""Prefix trie, n-gram classifier and phrase mining against brute force, held-out accuracy, odd and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import SF_MID, SF_SMALL, make_docs, no_docs, odd_docs, words  # noqa: F401

from ledgerwarden.llm import collocations, ngram_quality, prefix_trie, queries
from ledgerwarden.llm.common import mix64, run_hashes, table
from ledgerwarden.llm.oracle_sql import ORACLE_SQL
from ledgerwarden.llm.radix_tree import insert
from ledgerwarden.llm.textparts import text_parts
from ledgerwarden.llm.word_trie import Alphabet, build

CONV = "conv_id long, turn long, role string, text string, key string, h long, own string, opener long"


def sql_rows(sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = con.sql(ORACLE_SQL[name])
    return [c for c in got.columns], got.fetchall()


# --- texts in parts ------------------------------------------------------------------

def test_text_parts_cut_between_words_only():
    texts = ["a bc", None, "", "word " * 50 + "x" * 70 + " end of it", "last one"]
    col = pa.array(texts)
    whole = {i: words(t) for i, t in enumerate(texts)}
    for limit in (10, 33, 10_000):
        got = defaultdict(list)
        for p in text_parts(col, limit):
            for r in range(p.rows):
                got[p.first + r] += words(p.raw[p.offsets[r]:p.offsets[r + 1]].tobytes().decode())
        assert {i: got[i] for i in whole} == whole


# --- prefix trie -----------------------------------------------------------------------

def test_radix_tree_layouts_and_values():
    rng = random.Random(3)
    keys = {bytes(rng.randrange(256) for _ in range(rng.choice([1, 2, 3]))) for _ in range(3000)} | {b"", b"ab", b"abcdefgh", b"abcdxyz"}
    root, layouts = None, set()
    for k in sorted(keys):
        root, node = insert(root, k, k)
        assert node.value == k
    found, stack = {}, [(root, b"")]
    while stack:
        node, at = stack.pop()
        at += node.prefix
        layouts.add(node.layout)
        if node.value is not None:
            found[at] = node.value
        kids = list(node.children())
        assert [b for b, _ in kids] == sorted(b for b, _ in kids) and len(kids) <= node.layout
        assert all(node.child(b) is kid for b, kid in kids)
        stack.extend((kid, at + bytes([b])) for b, kid in kids)
    assert found == {k: k for k in keys}
    rng_layouts = set(layouts)
    assert {4, 256} <= rng_layouts
    for n, layout in ((4, 4), (5, 16), (16, 16), (17, 48), (48, 48), (49, 256)):
        root = None
        for b in range(n):
            root, _ = insert(root, bytes([b * 5 % 256]), b)
        assert root.layout == layout and len(list(root.children())) == n


def brute_trie(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append(((t is not None, t or 0), r or "", x or ""))
    turns = {c: [(r, x) for _, r, x in sorted(v)] for c, v in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        k = tuple(turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
        ends[k].append(c)
        for d in range(len(k) + 1):
            members[k[:d]].append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(words(k[-1][1])) if k else 0
            leaves[k[:d]] += not kids[k]
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                    hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in members.items()), key=str)


def trie_rows(spark, rows, shard):
    df = spark.createDataFrame([(*r, "clash", 1, "clash", 2) for r in rows], CONV)
    return sorted(map(tuple, prefix_trie.prefix_trie(prefix_trie.with_openings(df), shard).collect()), key=str)


def test_trie_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(c, rng.choice([None, t, t]), rng.choice(["u", "a", None]), rng.choice(["x", "y z", None, "hello there you"]))
            for c in range(-60, 200) for t in range(rng.choice([0, 1, 2, 3, 8]))]
    rows += rows[:40] + [(None, 0, "u", "no conversation"), (None, None, None, None)]
    rows += [(c, t, "u", "same words here") for c in range(1000, 1200) for t in range(3)]
    rows += [(c, t, "u", f"turn {t}") for c in (2000, 2001) for t in range(300)]
    want = brute_trie(rows)
    for shard in (4096, 64, 8):                             # one range; many; several levels of them
        assert trie_rows(spark, rows, shard) == want
    saved, prefix_trie.RUN = prefix_trie.RUN, 3             # copies in many runs
    try:
        assert trie_rows(spark, rows, 64) == want
    finally:
        prefix_trie.RUN = saved


def test_trie_of_nothing(spark):
    assert trie_rows(spark, [], 8) == []
    assert trie_rows(spark, [(None, 1, "u", "x")], 8) == []
    assert trie_rows(spark, [(7, None, None, None)], 8) == brute_trie([(7, None, None, None)])


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op13_phrase_collocations"])
def test_queries_equal_their_sql(spark, name):
    columns, want = sql_rows(SF_SMALL, name)
    got = queries.QUERIES[name](spark, SF_SMALL).select(columns).collect()
    assert want and sorted(map(tuple, got), key=str) == sorted(want, key=str)


# --- n-gram classifier ---------------------------------------------------------------------

def brute_places(text):
    """n-gram places from the regex' words, one at a time."""
    found = re.findall(r"[0-9A-Za-z\u0080-\U0010FFFF]+|[^0-9A-Za-z\u0080-\U0010FFFF\x20\x09-\x0D]+", text or "")
    raw = [int(run_hashes(b, np.zeros(1, np.int64), np.array([len(b)]))[0])
           for b in (np.frombuffer(w.encode(), np.uint8) for w in found)]
    own = [int(ngram_quality._AGAIN[0]) if i >= 1 and h == raw[i - 1] else
           int(ngram_quality._AGAIN[1]) if i >= 2 and h == raw[i - 2] else h for i, h in enumerate(raw)]
    mask = (1 << 64) - 1
    both = [int(mix64(np.array([(a * int(ngram_quality._JOIN) + b) & mask], np.uint64))[0]) for a, b in zip(own, own[1:])]
    return Counter(x >> (64 - ngram_quality.BITS) for x in own + both)


def test_places_of_ngrams_whole_and_in_parts():
    texts = ["the the the&&& cat", None, "", "Straße naïve 中文 $$ x", "one two one two, one " * 9, "tail"]
    col = pa.array(texts)
    for limit in (12, 40, 1_000_000):
        got, before = defaultdict(Counter), []
        for part in text_parts(col, limit):
            row, place = ngram_quality.grams(part, before)
            for r, p in zip(row.tolist(), place.tolist()):
                got[part.first + r][p] += 1
        assert {i: got[i] for i in range(len(texts))} == {i: brute_places(t) for i, t in enumerate(texts)}


def test_updates_against_scalar_ones(monkeypatch):
    rng = random.Random(1)
    rows = [(sorted(rng.sample(range(50), 6)), [rng.random() for _ in range(6)]) for _ in range(40)]
    labels = [int(sum(x for a, x in zip(*r) if a < 25) > 1.2) for r in rows]
    monkeypatch.setattr(ngram_quality, "BITS", 6)
    model = ngram_quality.train([(np.array(a), np.array(v)) for a, v in rows], np.array(labels), passes=3, seed=4)
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        l1 = 0.0 if i == 64 else ngram_quality.L1
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((ngram_quality.BETA + math.sqrt(n[i])) / ngram_quality.ALPHA + ngram_quality.L2)

    order = np.random.default_rng(4)
    for _ in range(3):
        for r in order.permutation(len(rows)):
            at, x = [*rows[r][0], 64], [*rows[r][1], 1.0]
            w = [weight(i) for i in at]
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x))))
            for i, xi, wi in zip(at, x, w):
                g = (p - labels[r]) * xi
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / ngram_quality.ALPHA * wi
                n[i] += g * g
    assert np.allclose(model.weights, [weight(i) for i in range(64)], atol=1e-6) and math.isclose(model.bias, weight(64), abs_tol=1e-9)


def test_quality_of_held_out_documents(spark):
    rows = queries.op12_ngram_quality(spark, SF_MID).collect()
    told = {r.doc_id: r.quality for r in table(spark, SF_MID, "labels").collect()}
    assert len(rows) == table(spark, SF_MID, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in told]
    right = sum(r.predicted == told[r.doc_id] for r in held)
    assert len(held) > 40 and right >= 0.97 * len(held)
    again = {(r.doc_id, r.score) for r in queries.op12_ngram_quality(spark, SF_MID).collect()}
    assert again == {(r.doc_id, r.score) for r in rows}


def test_classifier_on_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(5, 1), (5, 1), (8, 1), (8, 0), (9, 0), (7, None), (0, 7), (None, 1), (1, 1)],
                                   "doc_id long, quality int")
    rows = ngram_quality.training_rows(odd_docs, labels).orderBy("doc_id").collect()
    assert [(r.doc_id, r.label) for r in rows] == [(1, 1), (5, 1), (9, 0)]      # 8 disagrees; 9 is one row of its two texts
    assert ngram_quality.training_rows(odd_docs, labels, max_rows=2).count() == 2
    model = ngram_quality.fit(odd_docs, labels)
    scored = ngram_quality.score(odd_docs, model, ["doc_id", "h"]).collect()
    assert len(scored) == odd_docs.count() and all(0 <= r.score <= 1 for r in scored)
    texts = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id not in (None, 8, 9)}
    empty = 1 / (1 + math.exp(-model.bias))
    assert all(math.isclose(r.score, empty) for r in scored if r.doc_id in texts and not words(texts[r.doc_id]))
    assert ngram_quality.score(no_docs, model, ["doc_id"]).count() == 0
    none = ngram_quality.fit(odd_docs, labels.where("false"))
    assert {r.score for r in ngram_quality.score(odd_docs, none, ["doc_id"]).collect()} == {0.5}
    with pytest.raises(ValueError):
        ngram_quality.score(odd_docs.withColumnRenamed("h", "Score"), model, ["doc_id", "Score"])


# --- phrases -----------------------------------------------------------------------------------

def brute_phrases(rows, least, top, cover=50):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    often = {k: a for k, a in f.items() if len(k) > 2 and a >= least}
    inside = {s for k, a in often.items() if len(k) == 4 for s in ((*k[:3],), (k[0], *k[2:])) if 100 * a >= cover * often[s]}
    found = defaultdict(list)
    for k, a in often.items():
        if k not in inside:
            score, _, l, r = min((1_000_000 * a * a // (f[k[:i + 1]] * f[(k[0], *k[i + 1:])]), i, f[k[:i + 1]], f[(k[0], *k[i + 1:])])
                                 for i in range(1, len(k) - 1))
            found[k[0]].append((-score, -a, " ".join(k[1:]).encode(), l, r))
    return [(lang, i, p.decode(), -a, l, r, n[lang], -s) for lang in sorted(found)
            for i, (s, a, p, l, r) in enumerate(sorted(found[lang])[:top], 1)]


def phrases(df, **options):
    return sorted(map(tuple, collocations.mine(df, **options).collect()))


def test_word_trie_counts():
    rng = np.random.default_rng(1)
    text = (rng.zipf(1.3, 60_000) % 900 + 7).astype(np.uint64)
    piece = np.cumsum(rng.random(len(text)) < 0.1)
    n = Counter()
    for k in (2, 3):
        same = piece[k - 1:] == piece[:len(piece) - k + 1]
        n.update(tuple(int(x) for x in text[i:i + k]) + (0,) * (3 - k) for i in np.flatnonzero(same))
    some = sorted(n, key=lambda p: (-n[p], p))[:4000] + [(5, 6, 0), (int(text[0]), 5, 6)]
    trie, state = build(np.array(some, np.uint64))
    got = np.zeros(len(trie.check), np.int64)
    alphabet = Alphabet({0: trie})
    for _, _, at in trie.advance(alphabet.numbers[0][alphabet.places(text)], piece, 3):
        got += np.bincount(at, minlength=len(got))
    assert len(set(state.tolist())) == len(some) and trie.accepts.sum() == len(some)
    assert got[state].tolist() == [n[p] for p in some]


def test_phrases_against_brute_force(spark, odd_docs, monkeypatch):
    rng = random.Random(2)
    rows = [(" ".join(rng.choice(["a", "B", "c", "d.", "é", "f\x0bg", "New York", "new york city", ",", "h\tI", "j\nk"])
                      for _ in range(rng.choice([0, 1, 5, 60]))), rng.choice(["en", "fr", None, "und"])) for _ in range(150)]
    rows += rows[:30] + [(None, "en"), ("", None), ("x y " * 5000 + "x y z", "en")]
    df = make_docs(spark, [(i, t, lang) for i, (t, lang) in enumerate(rows)]).withColumnRenamed("size", "symbol").withColumnRenamed("h", "a")
    for options in ({"least": 2, "top": 2000}, {"least": 4, "top": 7}, {"least": 10 ** 6, "top": 5}):
        assert phrases(df, **options) == brute_phrases(rows, **options)
    monkeypatch.setattr(collocations, "BLOCK", 20)                     # many tries, several readings
    monkeypatch.setattr(collocations, "SMALL", 0)                      # no lookup is broadcast
    assert phrases(df, least=2) == brute_phrases(rows, 2, 2000)
    odd = [(r.text, r.lang) for r in odd_docs.collect()]
    assert phrases(odd_docs, least=2) == brute_phrases(odd, 2, 2000)


def test_rare_triples_of_frequent_pairs_do_not_travel(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(500)), lang) for lang in ("en", "fr") for _ in range(50)]
    made, stage = {}, collocations.stage

    def counted(df, label):
        out = stage(df, label)
        made[label] = made.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(collocations, "stage", counted)
    df = make_docs(spark, [(i, t, lang) for i, (t, lang) in enumerate(rows)]).repartition(4)
    least, f = 12, Counter()
    for text, lang in rows:
        w = text.split()
        f.update((lang, *w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    often = sum(n >= least for n in f.values())
    assert sum(len(k) == 4 for k in f) > 10 * often                     # nearly all triples are rare, nearly no pair is
    assert phrases(df, least=least) == brute_phrases(rows, least, 2000)
    assert made["found"] <= 1.2 * often


def test_phrases_with_cut_hashes_that_meet(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(" ".join(f"w{int(rng.paretovariate(0.6)) % 3000}" for _ in range(300)), rng.choice(["en", None])) for _ in range(80)]
    df = make_docs(spark, [(i, t, lang) for i, (t, lang) in enumerate(rows)]).repartition(3)
    monkeypatch.setattr(collocations, "BITS", (8, 8))                  # tables that refuse little
    monkeypatch.setattr(collocations, "SPARE", -4)                     # far fewer cut hashes than phrases
    monkeypatch.setattr(collocations, "GROUP", 10)                     # many groups
    assert phrases(df, least=3) == brute_phrases(rows, 3, 2000)


def test_cut_hashes_are_packed_and_summed(monkeypatch):
    monkeypatch.setattr(collocations, "KEPT", 100)                     # let go of often
    rng = np.random.default_rng(3)
    values = np.concatenate([(rng.zipf(1.4, 4000) % 5000).astype(np.uint64) << np.uint64(17), np.array([0, (1 << 30) - 1] * 7, np.uint64)])
    for low, cap in ((30, 9), (22, 9), (25, 100_000)):
        tally = collocations.Tally(cap)
        sent = [collocations._packed(*out, low) for part in np.array_split(values, 40) for out in tally.add(part)]
        sent += [collocations._packed(*out, low) for out in tally.rest()]
        assert len(sent) > 1 and not tally.rest()
        every = pa.Table.from_batches(sent)
        found = []
        for g in set(every["group"].to_pylist()):
            group = every.filter(pa.compute.equal(every["group"], g))
            found += collocations._often(low, 30, 9)(group)["symbol"].to_numpy().view(np.uint64).tolist()
        want, n = np.unique(values, return_counts=True)
        assert sorted(found) == [int(x) << 34 for x in want[n >= 9].tolist()]


def test_what_a_task_remembers_to_have_sent():
    sent = collocations.Sent(3)                                         # 16 places
    values = np.array([0, 1, 2, 1 << 60, 5 << 60], np.uint64)
    assert sent.fresh(values).all()
    again = sent.fresh(values)
    assert not again[3:].any() and again[:3].sum() >= 2                 # a place keeps one; what it lost is sent again
    assert sent.fresh(np.array([7 << 60], np.uint64)).all()


def test_phrases_of_nothing(spark, no_docs):
    assert phrases(no_docs) == []
    assert phrases(make_docs(spark, [(1, "one two"), (2, None)])) == []
    assert phrases(make_docs(spark, [(1, "one. " * 30)])) == []


def test_phrases_across_parts():
    text = "a b c, d e f g h " * 30 + "x" * 40 + " tail a b"
    col, language = pa.array([text]), np.zeros(1, np.uint64)

    def grams(limit):
        n, before = Counter(), []
        for part in text_parts(col, limit):
            s = collocations.Stream(part, language, before)
            n.update(("w", int(x)) for x in s.symbols[s.kept:])
            for k, end, h in s.hashes():
                n.update((k, int(x)) for x in h[end >= s.kept])
        return n

    assert grams(10) == grams(25) == grams(10_000)


def test_phrases_in_four_readings_whatever_the_number_of_blocks(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(" ".join(rng.choice("abcdefghijklmnopqrst") for _ in range(400)), lang) for lang in ("en", "fr", None) for _ in range(40)]
    df = make_docs(spark, [(i, t, lang) for i, (t, lang) in enumerate(rows)]).repartition(3)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    for block in (1 << 30, 25):                                         # one trie, more than a hundred
        monkeypatch.setattr(collocations, "BLOCK", block)
        seen.value = 0
        assert phrases(df.mapInArrow(counted, df.schema), least=3) == brute_phrases(rows, 3, 2000)
        assert seen.value == 4 * len(rows)                              # words, pairs, triples, positions


def test_a_block_counts_its_positions(monkeypatch):
    monkeypatch.setattr(collocations, "STEPPED", 50)                    # several steps
    monkeypatch.setattr(collocations, "KEPT", 200)                      # let go of often
    monkeypatch.setattr(collocations, "DEALT", 30)
    rng = np.random.default_rng(8)
    words = rng.integers(1, 9, (6000, 3)).astype(np.uint64) << np.uint64(40)
    words[rng.random(6000) < 0.4, 2] = 0
    key = words @ np.array([1, 11, 121], np.uint64)
    windows = collocations.Windows()
    dealt = [b for part in np.array_split(np.arange(6000), 30) for out in windows.add(key[part], words[part])
             for b in collocations._window_rows(*out, 7)]
    dealt += [b for out in windows.rest() for b in collocations._window_rows(*out, 7)]
    want = Counter()
    for last, middle, first in words.tolist():
        want[middle, last, 0] += 1
        if first:
            want[first, middle, last] += 1
    every, got = pa.Table.from_batches(dealt), Counter()
    assert len(dealt) > 7 and 1 < len(set(every["block"].to_pylist())) <= 7
    for g in set(every["block"].to_pylist()):
        for r in collocations._count_block(20)(every.filter(pa.compute.equal(every["block"], g))).to_pylist():
            assert (r["a"], r["b"], r["c"]) not in got and r["symbol"] is None
            got[r["a"], r["b"], r["c"]] = r["f"]
    assert got == {p: n for p, n in want.items() if n >= 20}


def test_words_of_any_length_have_hashes_of_their_own():
    words = sorted({(c * n)[:n] for c in ("a", "b", "ab", "a\0", "\0") for n in (1, 2, 7, 8, 9, 15, 16, 17, 63, 64, 65, 72, 200)})
    col = pa.array([" ".join(words), " ".join(reversed(words))])
    (part,) = text_parts(col)
    s = collocations.Stream(part, np.zeros(2, np.uint64), [])
    assert len(set(s.symbols.tolist())) == len(words) and s.symbols[:len(words)].tolist() == s.symbols[len(words):][::-1].tolist()


def test_phrases_of_small_batches_leave_the_setting(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = [("a b c. a b", "en")] * 9
    df, own = make_docs(spark, [(i, t, lang) for i, (t, lang) in enumerate(rows)]).coalesce(1), spark.conf.get(key)
    longest = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            longest.add(int(batch.num_rows > 2))
            yield batch

    monkeypatch.setattr(collocations, "BATCH", 2)
    assert phrases(df.mapInArrow(counted, df.schema), least=2) == brute_phrases(rows, 2, 2000)
    assert longest.value == 0 and spark.conf.get(key) == own
