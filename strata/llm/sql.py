"""DuckDB SQL of the queries that SQL can express. The others have none:
winnowing and the license scan choose by hash values, SentencePiece and the
token counts need a vocabulary file, the lexer of the secret scan, the
classifier and the HTML renderer are no SQL."""

from __future__ import annotations

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACE_WORDS = r"[^\x20\x09-\x0D]+"
TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BENCH_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

NEAR = f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER}, '{SPACE_WORDS}'), []) AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) < 2 THEN ws ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS s FROM w
),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
often AS (SELECT x, count(*) AS c FROM one GROUP BY x),
-- of linked sets the rarest shingles, all but 80 % of each set, have one in common
ranked AS (SELECT doc_id, n, x, row_number() OVER (PARTITION BY doc_id ORDER BY c, x) AS r FROM one JOIN often USING (x)),
tried AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM ranked a JOIN ranked b ON a.x = b.x AND a.doc_id < b.doc_id
  WHERE a.r <= a.n - CAST(ceil(0.8 * a.n) AS BIGINT) + 1 AND b.r <= b.n - CAST(ceil(0.8 * b.n) AS BIGINT) + 1
),
linked AS (
  SELECT t.a, t.b FROM tried t JOIN sets p ON p.doc_id = t.a JOIN sets q ON q.doc_id = t.b
  WHERE 100 * len(list_intersect(p.s, q.s)) >= 80 * (len(p.s) + len(q.s) - len(list_intersect(p.s, q.s)))
),
both_ways AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach AS (SELECT doc_id, doc_id AS r FROM sets UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.r),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN least l ON l.doc_id = s.doc_id
"""

BENCH = f"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER}, '{BENCH_WORDS}'), []) AS ws FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, coalesce(regexp_extract_all({LOWER}, '{BENCH_WORDS}'), []) AS ws FROM benchmark),
patterns AS (
  SELECT DISTINCT item, least(len(ws), 10) AS m, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS p
  FROM (SELECT item, ws, unnest(range(1, greatest(2, len(ws) - 8))) AS i FROM items WHERE len(ws) > 0)
),
places AS (
  SELECT doc_id, i, m, array_to_string(ws[i:i + m - 1], ' ') AS p
  FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, (SELECT DISTINCT m FROM patterns) WHERE len(ws) >= m)
),
met AS (SELECT doc_id, i, places.m, item FROM places JOIN patterns ON patterns.p = places.p AND patterns.m = places.m),
hit AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM met) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(found.n, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM w LEFT JOIN hit ON hit.doc_id = w.doc_id LEFT JOIN found ON found.doc_id = w.doc_id
"""

REPEATS = f"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{SPACE_WORDS}'), []) AS ws FROM documents),
windows AS (
  SELECT doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)
),
least AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, k FROM (SELECT doc_id, unnest(range(i, i + 50)) AS k FROM windows JOIN least USING (h) WHERE doc_id > first)
),
kept AS (
  SELECT x.doc_id, count(*) AS n, string_agg(x.word, ' ' ORDER BY x.k) AS text
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS k FROM w) x
  LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.k = x.k WHERE gone.k IS NULL GROUP BY x.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""

EQUAL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM t WINDOW g AS (PARTITION BY norm)
"""

TRIE = """
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL
),
-- crc32 of the decimal id, bit by bit: an id's byte is xored in, then eight shifts
c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM o)
),
r AS (
  SELECT c.conv_id, o.p AS d, role, text FROM c JOIN o ON o.conv_id = c.base AND o.p <= c.h
  UNION ALL
  SELECT c.conv_id, o.p - c.h + least(c.h, (SELECT count(*) FROM o b WHERE b.conv_id = c.base)), role, text FROM c JOIN o ON o.conv_id = c.conv_id AND o.p > c.h
),
pre AS (
  SELECT conv_id, 0 AS d, '' AS k, 0 AS bytes FROM c
  UNION ALL
  SELECT conv_id, d, string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY d), strlen(text) FROM r
),
node AS (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes FROM pre GROUP BY d, k),
child AS (SELECT left(k, (d - 1) * 64) AS k, d - 1 AS d, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
below AS (
  SELECT x.a AS d, left(x.k, x.a * 64) AS k, sum(saved) AS saved, sum(leaf) AS leaves
  FROM (SELECT node.k, (n_convs - 1) * bytes AS saved, CASE WHEN child.n IS NULL THEN 1 ELSE 0 END AS leaf, unnest(range(0, node.d + 1)) AS a FROM node LEFT JOIN child ON child.d = node.d AND child.k = node.k) x
  GROUP BY ALL
),
final AS (SELECT k, d, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS s FROM (SELECT conv_id, arg_max(k, d) AS k, max(d) AS d FROM pre GROUP BY conv_id) GROUP BY ALL)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(child.n, 0) AS n_children,
  CAST(below.leaves AS BIGINT) AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, coalesce(final.s, sha256('')) AS ends_sha256
FROM node n JOIN below ON below.d = n.d AND below.k = n.k LEFT JOIN node p ON p.d = n.d - 1 AND p.k = left(n.k, (n.d - 1) * 64) AND n.d > 0
LEFT JOIN child ON child.d = n.d AND child.k = n.k LEFT JOIN final ON final.d = n.d AND final.k = n.k
"""

RANKED = rf"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER}, '{TERMS}'), []) AS ws FROM documents),
g AS (SELECT count(*) FILTER (len(ws) > 0) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM w),
items AS (SELECT DISTINCT item_id, unnest(coalesce(regexp_extract_all({LOWER}, '{TERMS}'), [])) AS t FROM benchmark),
tf AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS t FROM w) WHERE t IN (SELECT t FROM items) GROUP BY ALL),
weight AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, g GROUP BY t),
m AS (SELECT doc_id, 10 + (90 * len(ws) * n_docs) // n_terms AS m FROM w, g),
part AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * m)) AS x FROM tf JOIN weight USING (t) JOIN m USING (doc_id)),
scored AS (SELECT item_id, doc_id, CAST(sum(x) AS BIGINT) AS score FROM items JOIN part USING (t) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 10
"""

ORACLE_SQL = {"op3_odd_sketch": NEAR, "op5_wu_manber": BENCH, "op6_substring_dedup": REPEATS, "op11_exact_dedup": EQUAL, "op12_prefix_trie": TRIE, "op13_lexical_search": RANKED}
