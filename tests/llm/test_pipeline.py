"""The pipeline: each stage on its own input against a brute-force version, then run() as a whole."""

import zlib
from collections import defaultdict

import corpus_pipeline
from llm_helpers import SF_SMALL, make_docs, no_docs, odd_docs, words  # noqa: F401
from test_linejoin import brute as brute_lines
from test_mixing_and_simhash import brute_components, brute_fingerprint
from test_quality_and_langid import brute as brute_counts

import __spark_entry__ as entry
from ledgerwarden.llm.common import stage, table
from ledgerwarden.llm.tokens import PieceEncoder, vocabulary_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered():
    assert "pipeline" in entry.queries() and "pipeline" not in entry.oracle_sql()
    assert all(any(k.startswith(f"op{n}_") for k in entry.queries()) for n in range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "source_mix", "pack"]


def test_stages_one_by_one(spark):
    docs = table(spark, SF_SMALL, "documents")
    kept = stage(corpus_pipeline.quality_rules(spark, docs, SF_SMALL), "t")
    assert kept.columns == COLUMNS
    base = {d.doc_id for d in docs.collect() if (c := brute_counts(d.text))["n_words"] >= 20
            and 100 * c["n_repeat_words"] <= 30 * c["n_words"]}
    assert {d.doc_id for d in kept.collect()} <= base          # few labels at this size: no rule is certified
    assert len(base) - kept.count() == 0

    lines = stage(corpus_pipeline.line_dedup(spark, kept, SF_SMALL), "t")
    assert lines.columns == COLUMNS
    rows = [(d.doc_id, d.text) for d in kept.collect()]
    gone = {place for place, _, _, early in brute_lines(rows) if early is not None}
    want = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in rows}
    assert {d.doc_id: d.text for d in lines.collect()} == want
    assert all(d.n_chars == len(d.text) for d in lines.collect())

    one = stage(corpus_pipeline.near_duplicates(spark, lines, SF_SMALL), "t")
    fps = [(d, brute_fingerprint(t)) for d, t in want.items()]
    named = brute_components(fps)
    assert sorted(d.doc_id for d in one.collect()) == sorted(d for d, f in fps if named[f] == d)
    assert one.columns == COLUMNS

    mixed = stage(corpus_pipeline.source_mix(spark, one, SF_SMALL), "t")
    assert mixed.columns == COLUMNS
    size, taken = defaultdict(int), defaultdict(int)
    for d in one.collect():
        size[d.source] += len(words(d.text))
    for d in mixed.collect():
        taken[d.source] += len(words(d.text))
    from ledgerwarden.llm import mixing
    goal = mixing.targets([size[s] for s in sorted(size)], [(5, 2, 1)[i % 3] for i in range(len(size))])
    assert all(abs(taken[s] - g) <= 0.02 * g + 2 for s, g in zip(sorted(size), goal))

    packed = corpus_pipeline.pack(spark, mixed, SF_SMALL).collect()
    enc = PieceEncoder(vocabulary_path())
    ids, counts = enc.encode([d.text for d in mixed.collect()])
    assert sum(r.length for r in packed) == len(ids) + len(counts)


def test_run_and_odd_rows(spark, odd_docs, no_docs):
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    seqs = defaultdict(int)
    for r in rows:
        seqs[r.sequence_id] += r.length
    assert rows and max(seqs.values()) <= 1024
    for start in (odd_docs, no_docs):
        docs = start
        for name, f in corpus_pipeline.STAGES:
            docs = stage(f(spark, docs, SF_SMALL), f"odd-{name}")
            assert name == "pack" or docs.columns == start.columns
        assert (docs.count() > 0) == (start is odd_docs)
    assert zlib.crc32(b"") == 0
