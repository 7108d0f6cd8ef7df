"""Stated bounds: one holdout per labelled id, hard sample limits, no words out of the mix's reach, clashing names."""

import random

import pytest
from llm_helpers import make_docs, no_docs, odd_docs  # noqa: F401

from ledgerwarden.llm import ann, chat, langid, mixing, quality, warcindex


def test_repeated_rows_of_a_labelled_id_are_one_holdout(spark):
    rng = random.Random(4)
    good = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "epsilon"]) + str(rng.randrange(500)) for _ in range(60)))
            for i in range(15)]
    junk = [(100 + i, " ".join(rng.choice(["###", "$$$", "%%%"]) + str(rng.randrange(500)) for _ in range(60))) for i in range(15)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in junk], "doc_id long, quality int")
    for times in (1, 10):
        docs = make_docs(spark, (good + junk) * times)
        counts = quality.with_counts(docs, ["doc_id", "lang"])
        assert quality.fit_cutoffs(counts, labels) == {}                # 107 holdouts are the least


@pytest.mark.parametrize("hot", [None, 7])
def test_language_sample_is_limited_whatever_the_ids(spark, hot):
    rng = random.Random(1)
    stems = {"en": ["the", "house", "of", "and"], "fr": ["la", "maison", "de", "et"], "de": ["das", "haus", "und", "der"]}
    rows = [(hot if i % 3 else i, " ".join(rng.choice(stems[lang]) + rng.choice(["", "s", str(i)]) for _ in range(8)), lang)
            for i in range(700) for lang in stems]
    rows += [(hot, "la maison de la rue", "fr")] * 300
    seen = []
    model = langid.Model
    docs = make_docs(spark, rows)

    class Counted(model):
        def __init__(self, x, y):
            seen.append(list(y))
            super().__init__(x, y)

    langid.Model = Counted
    try:
        fitted = langid.fit(docs, max_rows=120)
        langid.fit(docs, max_rows=120, max_languages=2)
    finally:
        langid.Model = model
    assert all(seen[0].count(lang) == 40 for lang in stems)             # hard limit, and no class starved
    assert set(seen[1]) == {"fr", "de"} and len(seen[1]) == 120         # fr has most rows; de before en by name
    assert fitted.predict(["das haus und der", "la maison et de"])[0] == ["de", "fr"]


def test_every_word_can_be_picked(spark):
    docs = make_docs(spark, [(i, " ".join(f"w{i}x{j}" for j in range(97)), "en", "a" if i % 9 else "b") for i in range(200)])
    rows = mixing.sized(docs, ["doc_id"])
    q = mixing.quotas(rows)
    blocks = {(source, shard): (n, m) for source, shard, _, n, m, _ in q.shards}
    words = {(r["__lw_source"], r["__lw_shard"]): r.n for r in
             mixing._sharded(rows, q.sources).groupBy("__lw_source", "__lw_shard").agg({"__lw_size": "sum"})
             .withColumnRenamed("sum(__lw_size)", "n").collect()}
    assert all(n * q.block >= words[k] for k, (n, _) in blocks.items())
    for w, block, start in [(1000, 64, 3), (64, 64, 0), (65, 64, 1), (10, 64, 0)]:
        n = -(-w // block)
        for want in range(0, w, 7):
            m = mixing._nearest(want, w, block, n, start)
            picked = sum(min(block, w - j * block) for j in range(n) if ((j + 1) * m + start) // n > (j * m + start) // n)
            assert abs(picked - want) <= block


def test_rows_without_id_are_dealt_to_many_shards(spark):
    docs = make_docs(spark, [(None, " ".join(f"w{i}x{j}" for j in range(60))) for i in range(1500)])
    rows = mixing.sized(docs, [])
    sources = [("a", 90_000, 90_000.0, 6)]
    per = mixing._sharded(rows, sources).groupBy("__lw_shard").count().collect()
    assert len(per) == 6 and max(r["count"] for r in per) < 400


CLASHES = ["src", "shard", "h", "n", "at", "size", "place", "rank", "apart", "bits", "stratum", "places", "good", "state", "key"]


def test_clashing_names_pass_through(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        wide = docs.select("*", *[__import__("pyspark").sql.functions.lit(i).alias(c) for i, c in enumerate(CLASHES)
                                  if c not in docs.columns])
        assert mixing.mix_documents(wide).columns == wide.columns
        assert mixing.mix_documents(wide).count() == mixing.mix_documents(docs).count()
        labels = spark.createDataFrame([(5, 1), (8, 0)], "doc_id long, quality int")
        assert quality.filter_documents(wide, labels).columns == wide.columns
        model = langid.fit(wide)
        assert langid.predict(wide, model, wide.columns).count() == wide.count()
    with pytest.raises(ValueError):
        langid.predict(odd_docs.withColumnRenamed("h", "score"), model, ["doc_id", "score"])


def test_chat_refuses_columns_named_like_its_results(spark):
    records = spark.createDataFrame([(1, '{"prompt": "a", "response": "b"}', "x")], "conv_id long, record string, extra string")
    turns = chat.canonical_turns(records)
    assert chat.format_turns(turns).count() == 1
    for name in ("turns", "layout", "Schema_Hash"):
        with pytest.raises(ValueError):
            chat.canonical_turns(records.withColumnRenamed("extra", name))
    for name in ("formatted", "loss_spans"):
        with pytest.raises(ValueError):
            chat.format_turns(turns.withColumnRenamed("extra", name))


@pytest.mark.parametrize("n", [170, 500, 2100])
def test_the_forest_is_searched_at_every_size(n):
    import numpy as np
    rng = np.random.default_rng(0)
    x = rng.standard_normal((n, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    forest = ann.BandedForest(np.arange(n), x)
    asked = []
    inner = ann.PrefixForest.candidates
    ann.PrefixForest.candidates = lambda self, *a: asked.append(inner(self, *a)) or asked[-1]
    try:
        out = forest.search(np.arange(100), x[:100], 20, ann.CANDIDATES)
    finally:
        ann.PrefixForest.candidates = inner
    hit = 0
    for i, (got, _) in enumerate(out):
        s = x @ x[i]
        s[i] = -9
        hit += len(set(np.argsort(-s)[:20].tolist()) & set(got.tolist()))
    assert hit >= 0.9 * 2000
    assert n < 300 or np.mean([len(a) for a in asked]) < 0.95 * n           # not the whole band


def test_records_are_read_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(warcindex, "READ_BYTES", 40_000)
    pages = spark.range(300).selectExpr("id page_id", "concat('http://host', id % 7, '.org/', id) url", "repeat(uuid(), 2000) html")
    index = warcindex.write_archives(pages.repartition(2))
    found = warcindex.lookup(warcindex.url_keys(pages), index)
    got = warcindex.read_records(found)
    assert got.rdd.getNumPartitions() == -(-found.agg({"size": "sum"}).first()[0] // warcindex.READ_BYTES) > 1
    assert got.select("page_id").distinct().count() == 300
