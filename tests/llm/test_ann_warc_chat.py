"""Nearest neighbours against brute force, WARC round trips, chat round trips."""

import base64
import gzip
import hashlib
import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import SF_MID, SF_SMALL

from ledgerwarden.llm import ann, chat, queries, warcindex
from ledgerwarden.llm.common import table


def recall(rows, ids, x, k=20):
    by = {}
    for r in rows:
        by.setdefault(r.query_id, []).append(r)
    hits = total = 0
    for q, found in by.items():
        s = x @ x[np.flatnonzero(ids == q)[0]]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        hits += len({r.vec_id for r in found} & set(ids[order].tolist()))
        total += len(order)
    return hits / total


def test_op2_recall_order_and_scores(spark):
    rows = queries.op2_hash_prefix_forest(spark, SF_MID).collect()
    data = table(spark, SF_MID, "embeddings").collect()
    ids, x = np.array([r.vec_id for r in data]), np.array([r.embedding for r in data], float)
    at = {v: i for i, v in enumerate(ids.tolist())}
    assert {r.query_id for r in rows} == {int(i) for i in ids if i % 20 == 0}
    assert recall(rows, ids, x) >= 0.9
    last = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        assert r.vec_id != r.query_id
        assert r.score == pytest.approx(float(x[at[r.query_id]] @ x[at[r.vec_id]]), abs=1e-12)
        n, score, vec = last.get(r.query_id, (0, np.inf, -1))
        assert r["rank"] == n + 1 and (score > r.score or (score == r.score and vec < r.vec_id))
        last[r.query_id] = (r["rank"], r.score, r.vec_id)


def test_recall_of_a_larger_forest():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((6000, 64))
    forest = ann.PrefixForest(np.arange(6000), x, float(np.linalg.norm(x, axis=1).max()))
    hits, seen = 0, 0
    for q in range(0, 6000, 200):
        least = int(ann.CANDIDATES * 6000)
        at = forest.candidates(forest.ranges(forest.hash(x[q:q + 1]), least), 0, least)
        got, _ = forest.nearest(q, x[q], at, 20)
        seen += len(at)
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(got.tolist()) & set(np.argsort(-s)[:20].tolist()))
    assert hits / 600 >= 0.9 and seen / 30 < 0.95 * 6000


def lengthened(spark, folder, n, sigma=0.0):
    """n random directions of log-normal lengths (sigma 0: unit vectors), as arrays and as a table."""
    rng = np.random.default_rng(n)
    x = rng.standard_normal((n, 64))
    x *= (np.exp(sigma * rng.standard_normal(n)) / np.linalg.norm(x, axis=1))[:, None]
    rows = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, 64), pa.int32()), pa.array(x.ravel()))
    os.makedirs(path := f"{folder}/embeddings-{n}-{sigma}")
    pq.write_table(pa.table({"vec_id": np.arange(n), "embedding": rows}), f"{path}/part-0.parquet")
    return x, spark.read.parquet(path)


def hits_by_query(df, x, queries):
    """Of the 20 nearest of each of the first ``queries`` rows, how many nearest() finds."""
    found = {}
    for r in ann.nearest(df, f"id < {queries}").collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    scores = x[:queries] @ x.T
    scores[np.arange(queries), np.arange(queries)] = -np.inf
    return np.array([len(found[q] & set(np.argsort(-scores[q])[:20].tolist())) for q in range(queries)])


@pytest.mark.parametrize("n", [2100, 4000, 20_000])
def test_recall_with_defaults_by_table_size(spark, scratch, n):
    x, df = lengthened(spark, scratch, n)
    hits = hits_by_query(df, x, 300)
    print(f"recall at {n}: {hits.mean() / 20:.4f}, under 16 of 20: {(hits < 16).mean():.4f}")
    assert hits.mean() / 20 >= 0.95 and (hits < 16).mean() <= 0.02


@pytest.mark.parametrize("sigma", [0.1, 0.25, 0.5])
def test_recall_with_lengths_that_differ(spark, scratch, sigma):
    x, df = lengthened(spark, scratch, 8192, sigma)
    hits = hits_by_query(df, x, 300)
    print(f"recall at sigma {sigma}: {hits.mean() / 20:.4f}, under 16 of 20: {(hits < 16).mean():.4f}")
    assert hits.mean() / 20 >= 0.95 and (hits < 16).mean() <= 0.02


def test_bands_left_out_hold_none_of_the_nearest():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((5000, 16)) * np.exp(rng.standard_normal(5000))[:, None]
    forest = ann.BandedForest(np.arange(5000), x)
    for q, (got, scores) in enumerate(forest.search(np.arange(40), x[:40], 20, 1.0)):
        s = x @ x[q]
        s[q] = -np.inf
        assert got.tolist() == np.argsort(-s)[:20].tolist() and np.allclose(scores, s[got])
    rows = np.array([[1.0, 5.0]] * 3 + [[1.0, 0.0]] * 2 + [[0.5, 0.0]])       # equal scores in two bands: the smaller id
    forest = ann.BandedForest(np.array([7, 8, 9, 1, 0, 2]), rows)
    got, scores = forest.search(np.array([0]), np.array([[1.0, 0.0]]), 2, 0.6)[0]
    assert len(forest.bands) == 3 and got.tolist() == [1, 7] and scores.tolist() == [1.0, 1.0]


def test_ann_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (40, [0.0, 0.0]), (None, [1.0, 1.0]), (1, [1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = [tuple(r) for r in ann.nearest(df, "id % 20 = 0").orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 2, 2.0), (0, 2, 1, 1.0), (0, 3, 20, 1.0), (20, 1, 2, 2.0), (20, 2, 0, 1.0), (20, 3, 1, 1.0)]
    assert ann.nearest(df.limit(0), "id % 20 = 0").collect() == []
    many = spark.createDataFrame([(i, [1.0, 0.5]) for i in range(200)], "vec_id long, embedding array<double>")
    got = ann.nearest(many, "id = 100", shard_rows=16).orderBy("rank").collect()
    assert [r.vec_id for r in got] == list(range(20))          # all equal: the smallest ids


# --- WARC ----------------------------------------------------------------------

def brute_pages(pages):
    least = {}
    for p in pages:
        if p.page_id is not None:
            body = (p.html or "").encode()
            least[body] = min(p.page_id, least.get(body, p.page_id))
    out = []
    for p in pages:
        body = (p.html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        first = least.get(body)
        revisit = first is not None and p.page_id != first
        out.append((p.page_id, len(body), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_op9_whole_table(spark):
    got = queries.op9_two_level_warc_index(spark, SF_MID)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_pages(table(spark, SF_MID, "pages").collect())


PAGES = "page_id long, url string, html string, file string"


def test_warc_odd_rows_blocks_and_lookup(spark, scratch):
    rows = [(i, f"http://www.Host{i % 3}.example.com/p/{i % 5}?q={i % 2}", f"<p>{i % 4}</p>") for i in range(60)]
    rows += [(70, None, None), (71, "", ""), (None, "http://a.b/", "<p>0</p>"), (None, "http://a.b/", "only here"), (3, rows[3][1], rows[3][2]),
             (80, "http://[bad", "x\r\n\r\ny"), (81, "http://a.b/\t\nz é", "z"), (82, "http://same/", "s" * 300_000)]
    rows += [(1000 + i, "http://same/", f"v{i}") for i in range(50)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], PAGES)
    index = warcindex.write_archives(pages, f"{scratch}/warc", block_lines=4, archive_bytes=2000)
    back = warcindex.read_records(warcindex.lookup(warcindex.url_keys(pages), index)).collect()
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r[n] for n in names) for r in back), key=str) == brute_pages(pages.collect())
    html = {r[0]: r[2] or "" for r in rows if r[0] is not None}
    assert all(r.payload == html[r.page_id] for r in back if r.page_id is not None and r.record_type == "response")
    found = warcindex.fetch(spark, ["http://same/"], index).collect()
    assert sorted(r.page_id for r in found) == [82, *range(1000, 1050)]
    assert warcindex.fetch(spark, ["http://nowhere/"], index).collect() == []
    none = warcindex.write_archives(pages.limit(0), f"{scratch}/none")
    assert warcindex.read_records(warcindex.lookup(warcindex.url_keys(pages), none)).collect() == []


def test_records_are_plain_warc():
    raw = warcindex.record(4, "http://a/", b"body", warcindex.digest32(b"body"), None)
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and raw.endswith(b"body\r\n\r\n")
    damaged = gzip.compress(raw.replace(b"body", b"bodY"))
    with pytest.raises(ValueError):
        warcindex.parse(damaged)


# --- chat ----------------------------------------------------------------------

def brute_chats(rows):
    import hashlib as h

    by = {}
    for r in rows:
        by.setdefault(r[0], []).append((r[1], r[2] or "", r[3] or ""))
    out = {}
    for conv, turns in by.items():
        turns = sorted(turns)
        loss = "".join(t for _, role, t in turns if role == "assistant")
        out[conv] = (len(turns), h.sha256("".join(f"{role}\n{t}\n" for _, role, t in turns).encode()).hexdigest(),
                     len(loss), h.sha256(loss.encode()).hexdigest())
    return out


def test_op10_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF_MID, "conversations").select("conv_id", "turn", "role", "text").collect()]
    probe = "\\### Assistant: </turn> ok"
    want = brute_chats(rows + [(-7, 0, "user", probe), (-7, 1, "assistant", probe)])
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
           for r in queries.op10_schema_chat_format(spark, SF_MID).collect()}
    assert got == want


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "human", "a\nb", "<turn>", "&#10;", ""]),
                                   st.text(alphabet="a&<>\\\n;l/turné\U0001f600# ", max_size=14)), max_size=5), min_size=1, max_size=6))
def test_any_text_comes_back(spark, convs):
    df = spark.createDataFrame([(i, [(r, t) for r, t in c]) for i, c in enumerate(convs)], f"conv_id long, turns {chat.TURNS}")
    out = (chat.format_turns(df).withColumnRenamed("turns", "given").withColumn("back", chat.read_turns())
           .withColumn("loss", chat.read_loss()).collect())
    for r in out:
        assert [tuple(t) for t in r.back] == [tuple(t) for t in r.given]
        assert r.loss == "".join(t.text for t in r.given if t.role == "assistant")
        assert r.formatted.count("<turn>") == r.formatted.count("</turn>\n") == len(r.given)


def test_layouts_by_fingerprint(spark):
    turns = [("user", "q"), ("assistant", "a")]
    layouts = [{"messages": [{"role": r, "content": t} for r, t in turns]}, {"messages": [{"text": t, "role": r} for r, t in turns]},
               {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, {"prompt": "q", "completion": "a"},
               {"response": "a", "prompt": "q"}, {"question": "q", "answer": "a"}, {"instruction": "q", "output": "a"},
               {"instruction": "q", "input": None, "output": "a"}, {"turns": [{"role": r, "text": t} for r, t in turns]}]
    odd = [None, "no json", "[1]", json.dumps({"prompt": "q"}), json.dumps({"messages": [{"role": "user", "content": 3}]})]
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate([*map(json.dumps, layouts), *odd])], "id int, record string, t string")
    got = chat.canonical_turns(df).orderBy("id").collect()
    assert all([tuple(t) for t in r.turns] == turns for r in got[:len(layouts)])
    assert all(r.turns is None and r.layout is None for r in got[len(layouts):])
    assert chat.fingerprint({"a": 1, "b": "x"}) == chat.fingerprint({"b": None, "a": 2.5}) != chat.fingerprint({"a": "1", "b": "x"})
    full = chat.Registry().canonical(json.dumps({"system": "s", "instruction": "i", "input": "more", "output": "o"}))
    assert full[1:] == ("instruction", [{"role": "system", "text": "s"}, {"role": "user", "text": "i\n\nmore"},
                                        {"role": "assistant", "text": "o"}])
    assert chat.format_turns(chat.canonical_turns(df)).where("turns IS NULL AND formatted IS NOT NULL").count() == 0
    assert chat.canonical_turns(df.limit(0)).collect() == []


def test_conversation_rows_with_nulls(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 0, "assistant", "x"), (None, 1, "user", None), (2, 0, "gpt", "g"), (2, 1, "user", "u")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.canonical_turns(queries.conversation_records(df)).collect()}
    assert got == {1: [("user", "first"), ("", ""), ("assistant", "x")], None: [("user", "")], 2: [("gpt", "g"), ("user", "u")]}
    assert table(spark, SF_SMALL, "conversations").count() > 0
