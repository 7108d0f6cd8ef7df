"""DuckDB SQL for the operators that SQL can express (same columns as the queries)."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# All pairs of lines that share a shingle, counted; no prefixes or filters.
_OP3 = rf"""
WITH parts AS (
  SELECT doc_id, unnest(range(len(l))) AS line_no, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
lines AS (
  SELECT doc_id, CAST(line_no AS INTEGER) AS line_no,
         regexp_extract_all(translate(line, '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM parts),
told AS (SELECT DISTINCT doc_id, line_no, w FROM lines WHERE len(w) > 0),
rows AS (SELECT doc_id, line_no, w FROM lines WHERE len(w) > 0),
classes AS (
  SELECT w, row_number() OVER () AS c, min(struct_pack(d := doc_id, l := line_no)) AS first FROM told GROUP BY w),
grams AS (
  SELECT DISTINCT c, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT c, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM classes)),
sizes AS (SELECT c, count(*) AS n FROM grams GROUP BY c),
near AS (
  SELECT a.c, b.c AS o FROM (
    SELECT x.c AS c, y.c AS o, count(*) AS k FROM grams x JOIN grams y ON x.g = y.g AND x.c <> y.c GROUP BY x.c, y.c) p
  JOIN sizes a ON a.c = p.c JOIN sizes b ON b.c = p.o WHERE 5 * k >= 4 * (a.n + b.n - k)),
best AS (SELECT n.c, count(*) AS n_links, min(k.first) AS first FROM near n JOIN classes k ON k.c = n.o GROUP BY n.c),
judged AS (
  SELECT r.doc_id, r.line_no, k.first AS own, coalesce(b.n_links, 0) AS n_links,
         list_min(list_filter([k.first, b.first], lambda p: p < struct_pack(d := r.doc_id, l := r.line_no))) AS early
  FROM rows r JOIN classes k ON k.w = r.w LEFT JOIN best b ON b.c = k.c)
SELECT doc_id, line_no, own.d AS class_doc, own.l AS class_line, n_links, early.d AS matched_doc, early.l AS matched_line,
       early IS NOT NULL AS removed
FROM judged
"""

_OP9 = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS least FROM pages),
d AS (
  SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, least,
         list_transform(range(0, 40), lambda i: CAST('0x' || substr(h, i + 1, 1) AS INTEGER)) AS x
  FROM (SELECT *, sha1(body) AS h FROM p))
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda g: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((x[(5 * g) // 4 + 1] * 16 + coalesce(x[(5 * g) // 4 + 2], 0)) >> (3 - (5 * g) % 4)) % 32 + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = least THEN NULL ELSE least END AS refers_to
FROM d
"""

_OP10 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
c AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS every,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), chr(10), '&#10;'))
             + length(replace(replace(text, '&', '&amp;'), '<', '&lt;')) + 15) AS formatted_chars
  FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(every) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM c
"""

# Every first-turns list of every rebuilt conversation, grouped; crc32 bit by bit.
_OP11 = r"""
WITH own AS (
  SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, ''))
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
sums AS (
  SELECT c, l, list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda b: CAST(ascii(b) AS BIGINT))),
      lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)),
                               lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)) AS crc
  FROM own),
rebuilt AS (
  SELECT a.c, list_concat(coalesce(o.l, a.l[1:0])[1:xor(a.crc, 4294967295) % 4], a.l[xor(a.crc, 4294967295) % 4 + 1:]) AS k
  FROM sums a LEFT JOIN own o ON o.c = a.c - a.c % 20),
firsts AS (SELECT c, k[1:d] AS p, len(k) = d AS ends FROM (SELECT c, k, unnest(range(len(k) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT p, min(c) AS low, count(*) AS n, string_agg(CASE WHEN ends THEN CAST(c AS VARCHAR) END, ',' ORDER BY c) AS ends
  FROM firsts GROUP BY p),
kids AS (SELECT p[1:len(p) - 1] AS p, count(*) AS n FROM nodes WHERE len(p) > 0 GROUP BY 1),
told AS (
  SELECT m.*, coalesce(k.n, 0) AS kids,
         CASE WHEN len(m.p) > 0 THEN (m.n - 1) * len(regexp_extract_all(m.p[len(m.p)].x, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved
  FROM nodes m LEFT JOIN kids k ON k.p = m.p),
trees AS (
  SELECT p[1:d] AS p, sum(CAST(kids = 0 AS INTEGER)) AS leaves, sum(saved) AS saved
  FROM (SELECT p, kids, saved, unnest(range(len(p) + 1)) AS d FROM told) GROUP BY 1)
SELECT m.low AS conv_id, CAST(len(m.p) AS BIGINT) AS depth, u.low AS parent_conv_id, m.n AS n_convs, CAST(m.kids AS BIGINT) AS n_children,
       CAST(t.leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, sha256(coalesce(m.ends, '')) AS ends_sha256
FROM told m JOIN trees t ON t.p = m.p LEFT JOIN nodes u ON len(m.p) > 0 AND u.p = m.p[1:len(m.p) - 1]
"""

# Every phrase of 1 to 3 words counted; no tries, no candidates.
_OP13 = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
grams AS (SELECT lang, w[i:i + k - 1] AS p FROM starts, range(1, 4) AS r(k) WHERE i + k - 1 <= len(w)),
counts AS (SELECT lang, p, count(*) AS f FROM grams GROUP BY lang, p),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE len(p) = 1 GROUP BY lang),
often AS (SELECT lang, p, f FROM counts WHERE len(p) >= 2 AND f >= 10),
cuts AS (
  SELECT o.lang, o.p, o.f, j, l.f AS l, r.f AS r, (CAST(1000000 AS HUGEINT) * o.f * o.f) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM (SELECT *, unnest(range(1, len(p))) AS j FROM often) o
  JOIN counts l ON l.lang = o.lang AND l.p = o.p[1:j] JOIN counts r ON r.lang = o.lang AND r.p = o.p[j + 1:]),
weakest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, j) AS place FROM cuts) WHERE place = 1),
longer AS (SELECT lang, unnest([p[1:2], p[2:3]]) AS p, f FROM often WHERE len(p) = 3),
most AS (SELECT lang, p, max(f) AS f FROM longer GROUP BY lang, p),
kept AS (
  SELECT w.lang, array_to_string(w.p, ' ') AS phrase, w.f AS a, w.l, w.r, w.score
  FROM weakest w LEFT JOIN most m ON m.lang = w.lang AND m.p = w.p WHERE m.f IS NULL OR 100 * m.f < 50 * w.f),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT k.lang, k.rank, k.phrase, k.a, k.l, k.r, CAST(t.n AS BIGINT) AS n, CAST(k.score AS BIGINT) AS score
FROM ranked k JOIN totals t ON t.lang = k.lang WHERE k.rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {
    "op3_line_similarity_join": _OP3,
    "op9_two_level_warc_index": _OP9,
    "op10_schema_chat_format": _OP10,
    "op11_prefix_trie": _OP11,
    "op13_phrase_collocations": _OP13,
}
