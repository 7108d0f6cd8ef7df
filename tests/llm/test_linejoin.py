"""Line join against all pairs of lines, and its SQL oracle."""

import duckdb
import pytest
from llm_helpers import SF_SMALL, make_docs, no_docs, odd_docs, words  # noqa: F401

from ledgerwarden.llm import linejoin, queries
from ledgerwarden.llm.common import table
from ledgerwarden.llm.oracle_sql import ORACLE_SQL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LAST = linejoin.LAST


def brute(rows):
    """{(doc, line): (class place, links, removed, match)} for rows of (doc_id, text)."""
    lines = [((LAST if d is None else d, i), tuple(w.translate(LOWER) for w in words(x)))
             for d, t in rows for i, x in enumerate((t or "").split("\n")) if words(x)]
    first = {}
    for place, w in lines:
        first[w] = min(place, first.get(w, place))
    sets = {w: {w[i:i + 5] for i in range(max(1, len(w) - 4))} for w in first}
    by_shingle = {}
    for w, s in sets.items():
        for g in s:
            by_shingle.setdefault(g, set()).add(w)
    near = {}
    for w, s in sets.items():
        others = set().union(*(by_shingle[g] for g in s)) - {w}
        near[w] = [o for o in others if 5 * len(s & sets[o]) >= 4 * len(s | sets[o])]
    out = []
    for place, w in lines:
        early = min([p for p in [first[w], *(first[o] for o in near[w])] if p < place], default=None)
        out.append((place, first[w], len(near[w]), early))
    return sorted(out, key=str)


def told(df):
    back = lambda d: LAST if d is None else d
    out = []
    for r in df.collect():
        early = (back(r.matched_doc), r.matched_line) if r.removed else None
        assert r.removed == (r.matched_line is not None)
        out.append(((back(r.doc_id), r.line_no), (back(r.class_doc), r.class_line), r.n_links, early))
    return sorted(out, key=str)


def variants(n):
    """Documents whose lines are near copies of each other, above and below the threshold."""
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        a, b = list(base), list(base[:30])
        if i % 4:
            a[(i * 13) % 60] = f"x{i}"
        if i % 3 == 0:
            a += [f"tail{i}"] * (i % 7)
        rows.append((i, "\n".join([" ".join(a), "", " ".join(b[i % 5:]), "Short line", f"only {i % 4}", " ".join(reversed(a))])))
    return rows


@pytest.mark.parametrize("group_rows,hot", [(1024, 1 << 20), (7, 1 << 20), (1024, 2)])
def test_equals_all_pairs(spark, group_rows, hot):
    rows = variants(60) + [(3, "w1 w2"), (200, None), (201, "")]
    df = make_docs(spark, rows)
    assert told(linejoin.judge_lines(df, group_rows=group_rows, hot=hot)) == brute(rows)


def test_op3_whole_table_and_oracle(spark):
    got = queries.op3_line_similarity_join(spark, SF_SMALL)
    rows = [(d.doc_id, d.text) for d in table(spark, SF_SMALL, "documents").collect()]
    assert told(got) == brute(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    rel = con.sql(ORACLE_SQL["op3_line_similarity_join"])
    want = sorted((tuple(r) for r in rel.fetchall()), key=str)
    assert sorted((tuple(r) for r in got.select(*rel.columns).collect()), key=str) == want


def test_dedup_documents(spark):
    same = "this line is said in several documents of the table"
    docs = make_docs(spark, [(2, f"Own words of two here\n{same}\n\nend of two is this"), (1, f"{same}\nown words of one here"),
                             (3, same.upper()), (4, "short\nshort")])
    out = {r.doc_id: r for r in linejoin.dedup_documents(docs).collect()}
    assert {k: r.text for k, r in out.items()} == {
        1: f"{same}\nown words of one here", 2: "Own words of two here\n\nend of two is this", 3: "", 4: "short"}
    assert out[2].n_chars == len(out[2].text) and out[2].h == "x"


def test_lists_of_rows_without_an_id_hold_one_text(spark):
    said = [f"line {i} is said by the first document of all" for i in range(200)]
    copies = [(None, "\n".join([f"own words of copy {c}", *said[4 * c:4 * c + 4]])) for c in range(30)]
    twice = [(9, "\n".join([f"own words of nine {c}", *said[100 + 4 * c:104 + 4 * c]])) for c in range(20)]
    rows = [(1, "\n".join(said)), *copies, *twice]
    docs = make_docs(spark, rows)
    assert told(linejoin.judge_lines(docs)) == brute(rows)
    lists = linejoin._gone(docs).collect()
    assert len(lists) == 50 and all(len(r["__lw_gone"]) == 4 for r in lists)
    texts = sorted(r.text for r in linejoin.dedup_documents(docs).where("doc_id IS NULL OR doc_id = 9").collect())
    assert texts == sorted(t.split("\n")[0] for _, t in copies + twice)
    classes = spark.createDataFrame([(h, (LAST, h), h % 5) for h in range(20)], "h long, first struct<doc: long, line: int>, key long")
    assert [len(r.wanted) for r in linejoin._wanted(classes, classes).collect()] == [4] * 5


def test_wanted_lists_are_broadcast_by_their_lines(spark):
    texts = spark.createDataFrame([(i, i, "x") for i in range(10)], "doc long, key long, text string")
    wanted = spark.createDataFrame([(i, i, list(range(100))) for i in range(10)], "doc long, key long, wanted array<long>")
    for limit, hinted in ((1000, True), (999, False)):
        met = linejoin._texts_wanted(texts, wanted, limit)
        assert ("strategy=broadcast" in met._jdf.queryExecution().analyzed().toString()) == hinted
        assert met.count() == 10
    rows = variants(20)
    assert told(linejoin.judge_lines(make_docs(spark, rows), wanted_lines=0)) == brute(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert told(linejoin.judge_lines(odd_docs)) == brute(rows)
    out = linejoin.dedup_documents(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    texts = {(r.doc_id, r.text) for r in out.collect()}
    assert (0, "zero") in texts and (None, "text without an id here") in texts and (1, None) in texts
    assert linejoin.dedup_documents(no_docs).collect() == []
