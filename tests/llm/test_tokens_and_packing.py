"""Token store and packing: exact round trips against the plain tokenizer, invariants of the windows."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_helpers import SF_SMALL, no_docs, odd_docs  # noqa: F401

from ledgerwarden.llm import packing, queries, token_store
from ledgerwarden.llm.common import table
from ledgerwarden.llm.tokens import PieceEncoder, vocabulary_path


@pytest.fixture(scope="module")
def enc():
    return PieceEncoder(vocabulary_path())


def whole(enc, text):
    return enc.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_equal_whole_texts(enc):
    rng = random.Random(3)
    bits = ["ab", "C", " ", "  ", "\n", "\t", "\r\n", "'", "'s", "'ll", "é", "ß", "²", "12", ".", "!?", "<|endoftext|>", "中",
            "\x1c", "\x85", "　", "日本", "ё", "…", "€", "\U0001f600", "longword"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    ids, counts = enc.encode(texts)
    for text, got in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert got.tolist() == whole(enc, text), text


def test_small_cache_gives_same_ids():
    small, texts = PieceEncoder(vocabulary_path(), cache_pieces=5), ["a bc def, ghi jkl mno pqr", "xyz a bc", ""]
    for _ in range(2):
        ids, counts = small.encode(texts)
        assert ids.tolist() == [i for t in texts for i in whole(small, t)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=900))
def test_elias_fano_select(values):
    values = np.sort(np.array(values, np.int64)) if values else np.zeros(0, np.int64)
    ef = token_store.EliasFano(token_store.EliasFano.encode(values))
    assert ef.select(0, len(values)).tolist() == values.tolist()
    for a, b in [(0, 1), (len(values) // 2, len(values)), (len(values) // 3, len(values) // 3 + 7)]:
        b = min(b, len(values))
        assert ef.select(a, b).tolist() == values[a:b].tolist()


def test_elias_fano_is_near_minimal():
    ends = np.cumsum(np.random.default_rng(1).integers(100, 3000, 50_000))
    assert len(token_store.EliasFano.encode(ends)) * 8 / len(ends) < 2 + np.log2(ends[-1] / len(ends)) + 1


def _brute_tokens(enc, rows):
    ordered = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    out, at = [], 0
    for r in ordered:
        ids = np.array([*whole(enc, r.text), 0], "<u4")
        out.append((r.doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_op1_whole_table(spark, enc):
    got = [tuple(r) for r in queries.op1_elias_fano_tokens(spark, SF_SMALL).collect()]
    want = _brute_tokens(enc, table(spark, SF_SMALL, "documents").select("doc_id", "text").collect())
    assert sorted(got) == sorted(want)


def test_token_store_odd_rows(spark, enc, odd_docs, no_docs, scratch):
    manifest = token_store.write_token_store(odd_docs, f"{scratch}/ids", shard_ids=40)     # many shards
    assert manifest.count() > 3
    got = token_store.read_token_store(spark, manifest).collect()
    want = _brute_tokens(enc, odd_docs.select("doc_id", "text").collect())
    key = lambda r: (r[1], r[2])
    assert sorted([(r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in got], key=key) == sorted(want, key=key)
    shards = [token_store.ShardReader(m.path) for m in manifest.collect()]
    found = [x for x in (s.find(7) for s in shards) if x is not None]
    assert [x.tolist()[:-1] for x in found] == [whole(enc, next(r.text for r in odd_docs.collect() if r.doc_id == 7))]
    assert all(s.find(6) is None for s in shards)
    empty = token_store.write_token_store(no_docs, f"{scratch}/none")
    assert token_store.read_token_store(spark, empty).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 1024), max_size=150))
def test_windows_hold_every_weight_once(weights):
    bins = packing.windows(np.array(weights, np.int64))
    assert sorted(i for b in bins for i in b) == list(range(len(weights)))
    assert all(sum(weights[i] for i in b) <= 1024 for b in bins)


def test_differencing_known_case():
    bins = packing.difference(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in b) for b in bins) == [14, 16]     # the textbook run of the method
    assert packing.windows(np.array([600, 600, 600]), 1024) and len(packing.windows(np.array([600, 600, 600]), 1024)) == 3


def _check_packing(rows, docs, enc):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[(r.doc_id, r.doc_tokens)].append(r)
        by_seq[r.sequence_id].append(r)
    padding = total = 0
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
        total += at
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    want = defaultdict(list)
    for d in docs:
        want[d.doc_id].append(np.array([*whole(enc, d.text), 0], "<u4"))
    assert total == sum(len(x) for v in want.values() for x in v)
    return padding, total, want


def test_op7_whole_table(spark, enc):
    docs = table(spark, SF_SMALL, "documents").collect()
    rows = queries.op7_differencing_pack(spark, SF_SMALL).collect()
    padding, total, want = _check_packing(rows, docs, enc)
    assert padding < 0.02 * total
    cover = defaultdict(list)
    for r in rows:
        ids = want[r.doc_id][0]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
        cover[r.doc_id].append((r.start, r.length))
    for doc, parts in cover.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == len(want[doc][0])
    assert set(cover) == set(want)


def test_packing_odd_rows(spark, enc, odd_docs, no_docs):
    _check_packing(packing.pack_documents(odd_docs).collect(), odd_docs.collect(), enc)
    assert packing.pack_documents(no_docs).collect() == []
