"""DuckDB SQL for the registered queries of this package that SQL can express."""

from __future__ import annotations

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

#: Every window of every item against every stretch of as many document words.
DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS ww
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
pos AS (
  SELECT rid, n, p, list_slice(w, p, p + n - 1) AS dw
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM win))),
hit AS (SELECT pos.rid, pos.p, pos.n, win.item_id FROM pos JOIN win ON pos.n = win.n AND pos.dw = win.ww),
covered AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM hit) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN items USING (rid)"""

#: Base 32 from the SHA-1's hex digits: five of them make four letters.
WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
f AS (SELECT page_id, payload, sha1(payload) AS h, min(page_id) OVER (PARTITION BY payload) AS first_id FROM p)
SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) AS BIGINT) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f"""

#: Every 50-byte string as hex digits, cut from stretches of 64 bytes and their 49 followers.
SUFFIX_DEDUP = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
stretch AS (
  SELECT rid, doc_id, c, substr(h, 128 * c + 1, 226) AS part
  FROM (SELECT *, unnest(range((length(h) // 2 + 63) // 64)) AS c FROM d)),
s AS (
  SELECT rid, doc_id, 64 * c + j AS i, substr(part, 2 * j + 1, 100) AS g
  FROM (SELECT *, unnest(range(least(64, length(part) // 2 - 49))) AS j FROM stretch)),
earliest AS (SELECT g, min(doc_id) AS first_id FROM s GROUP BY g),
starts AS (SELECT rid, i FROM s JOIN earliest USING (g) WHERE first_id < doc_id),
marked AS (SELECT rid, i, CASE WHEN i <= lag(i) OVER (PARTITION BY rid ORDER BY i) + 50 THEN 0 ELSE 1 END AS opens FROM starts),
numbered AS (SELECT rid, i, sum(opens) OVER (PARTITION BY rid ORDER BY i ROWS UNBOUNDED PRECEDING) AS k FROM marked),
spans AS (SELECT rid, k, min(i) AS a, max(i) + 50 AS z FROM numbered GROUP BY rid, k),
before AS (SELECT rid, a, z, coalesce(lag(z) OVER (PARTITION BY rid ORDER BY a), 0) AS free FROM spans),
cut AS (
  SELECT rid, count(*) AS n_spans, sum(z - a) AS n_removed, max(z) AS last,
         string_agg(substr(h, 2 * free + 1, 2 * (a - free)), '' ORDER BY a) AS kept
  FROM before JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN kept IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN cut USING (rid)"""

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

#: Every document's score for every item, from whole postings.
BALL_TREE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT row_number() OVER () AS iid, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
size AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) GROUP BY rid, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS wt FROM df, size),
want AS (SELECT DISTINCT iid, term FROM (SELECT iid, unnest(w) AS term FROM i)),
scored AS (
  SELECT iid, rid, CAST(sum(wt * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * len(d.w) * n_docs) // n_terms))))) AS BIGINT) AS score
  FROM want JOIN weight USING (term) JOIN tf USING (term) JOIN d USING (rid), size GROUP BY iid, rid),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM scored JOIN i USING (iid) JOIN d USING (rid) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""

#: crc32 of a decimal id, bit by bit; whole prefixes as keys; subtrees through each node's smallest conversation.
CONVERSATION_TRIE = r"""
WITH crc_table AS (
  SELECT list(list_reduce(list_prepend(CAST(b AS BIGINT), CAST(range(8) AS BIGINT[])),
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY b) AS t
  FROM (SELECT unnest(range(256)) AS b)),
t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d
  FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS pos FROM t),
conv AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda x, c: xor(x >> 8, tab[CAST(xor(x & 255, c) AS BIGINT) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t), (SELECT t AS tab FROM crc_table)),
turns AS (
  SELECT c.conv_id, 0 AS own, pos, role, text FROM conv c JOIN numbered n ON n.conv_id = c.base AND n.pos <= c.h
  UNION ALL SELECT conv_id, 1, pos, role, text FROM numbered JOIN conv USING (conv_id) WHERE pos > h),
rebuilt AS (
  SELECT conv_id, coalesce(list(struct_pack(role := role, text := text) ORDER BY own, pos) FILTER (WHERE own IS NOT NULL), []) AS p
  FROM conv LEFT JOIN turns USING (conv_id) GROUP BY conv_id),
path AS (SELECT conv_id, d, p[1:d] AS prefix, len(p) AS n FROM (SELECT *, unnest(range(len(p) + 1)) AS d FROM rebuilt)),
node AS (
  SELECT prefix, d, min(conv_id) AS m, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256,
         CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(prefix[d].text, '[^\x20\x09-\x0D]+')) END AS words
  FROM path GROUP BY prefix, d),
kids AS (SELECT prefix[1:d - 1] AS prefix, d - 1 AS d, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
counted AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (prefix, d)),
below AS (
  SELECT path.prefix, path.d, count(*) FILTER (WHERE v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved_tokens
  FROM path JOIN counted v ON path.conv_id = v.m AND path.d <= v.d GROUP BY path.prefix, path.d)
SELECT u.m AS conv_id, CAST(u.d AS BIGINT) AS depth, up.m AS parent_conv_id, u.n_convs, CAST(u.n_children AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, u.ends_sha256
FROM counted u JOIN below USING (prefix, d) LEFT JOIN node up ON up.d = u.d - 1 AND up.prefix = u.prefix[1:u.d - 1]"""

ORACLE_SQL = {"op2_decontaminate": DECONTAMINATE, "op4_warc": WARC, "op9_suffix_dedup": SUFFIX_DEDUP, "op10_topk": TOPK, "op11_ball_tree": BALL_TREE, "op12_conversation_trie": CONVERSATION_TRIE}
