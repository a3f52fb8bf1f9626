"""SQL for DuckDB that gives the same rows as the queries."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_EMBEDDINGS = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
good AS (SELECT vec_id, x, sqrt(list_sum(list_transform(x, lambda e: e * e))) AS n FROM v
         WHERE x IS NOT NULL AND len(list_filter(x, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0
           AND len(list_filter(x, lambda e: e <> 0)) > 0),
e AS (SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
      WHERE list_dot_product(a.x, b.x) / (a.n * b.n) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, e.y FROM r JOIN e ON r.b = e.x),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY 1),
n AS (SELECT x, count(*) AS n FROM e GROUP BY 1)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v LEFT JOIN n ON n.x = v.vec_id JOIN c ON c.a = v.vec_id
"""

OP2_JACCARD = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 5
        THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
sym AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, sym.y FROM r JOIN sym ON r.b = sym.x),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN c ON c.a = d.doc_id
"""

#: The words of a text.
_WORDS = rf"""regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP3_DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark)),
win AS (SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS x
        FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b WHERE n > 0)),
pos AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
hit AS (SELECT p.doc_id, p.i, p.n, win.item_id
        FROM (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS x FROM pos) p JOIN win ON p.n = win.n AND p.x = win.x),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""

#: Texts as hex, two digits a byte. Strings are told apart by MD5.
OP4_REPEATS = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
k AS (SELECT r, i, md5(substr(h, 2 * i + 1, 800)) AS k FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 399)) AS i FROM d WHERE length(h) >= 800)),
s AS (SELECT r, i FROM k JOIN (SELECT k FROM k GROUP BY k HAVING count(*) > 1) USING (k)),
g AS (SELECT r, i, sum(CASE WHEN i <= prev + 400 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS run
      FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS prev FROM s)),
spans AS (SELECT r, run, min(i) AS low, max(i) + 400 AS high FROM g GROUP BY 1, 2),
between_spans AS (
  SELECT r, coalesce(lag(high) OVER (PARTITION BY r ORDER BY low), 0) AS a, low AS b FROM spans
  UNION ALL SELECT r, max(high), NULL FROM spans GROUP BY r),
kept AS (SELECT r, sha256(unhex(string_agg(substr(h, 2 * a + 1, CASE WHEN b IS NULL THEN length(h) ELSE 2 * (b - a) END), '' ORDER BY a, b NULLS LAST))) AS kept_sha256
         FROM between_spans JOIN d USING (r) GROUP BY r),
n AS (SELECT r, CAST(sum(high - low) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  coalesce(kept_sha256, sha256(unhex(h))) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN kept USING (r)
"""

OP9_WARC = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, max(page_id) AS original FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
  CASE WHEN f.original IS NOT NULL AND p.payload_bytes >= 1000 AND p.page_id IS DISTINCT FROM f.original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.original IS NOT NULL AND p.payload_bytes >= 1000 AND p.page_id IS DISTINCT FROM f.original THEN f.original END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

OP11_RANKING = rf"""
WITH w AS (SELECT doc_id, row_number() OVER () AS row, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT row, doc_id, CAST(len(w) AS BIGINT) AS n FROM w WHERE len(w) > 0),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM d),
p AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM w) GROUP BY 1, 2),
f AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
q AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
x AS (SELECT q.item_id, q.text, p.row, CAST(sum(
        CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT)
        * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // length)))) AS BIGINT) AS score
      FROM q JOIN f USING (term) JOIN p USING (term) JOIN d USING (row), s GROUP BY 1, 2, 3),
r AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id, x.text ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
      FROM x JOIN d USING (row) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""

_ENCODED = ", ".join(
    f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen(CAST({name} AS VARCHAR)) || ':' || CAST({name} AS VARCHAR) END"
    for name in ("doc_id", "source", "lang", "n_chars", "{text}")
)

#: crc32 of the decimal doc_id, bit by bit.
_CRC_OF_ID = """xor(list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [CAST(0 AS BIGINT) for _ in range(8)]),
        lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

OP12_MANIFEST = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, source, sha256(concat({_ENCODED.format(text="text")})) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_CRC_OF_ID} % 2 = 0
         THEN sha256(concat({_ENCODED.format(text="replace(text, chr(10), '')")})) END AS tampered FROM documents),
r AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS size,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM l),
g(tree, level, place, size, digest) AS (
  SELECT tree, 0, place, size, leaf FROM r
  UNION ALL
  SELECT tree, level + 1, place // 3, (size + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM g
  WHERE size > 1 GROUP BY tree, level, place // 3, size),
t(level, place, size, digest) AS (
  SELECT 0, tree, (SELECT max(tree) + 1 FROM r), digest FROM g WHERE size = 1
  UNION ALL
  SELECT level + 1, place // 3, (size + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM t
  WHERE size > 1 GROUP BY level, place // 3, size),
walk(tree, place, level, pos) AS (
  SELECT tree, place, 0, place FROM r
  UNION ALL
  SELECT w.tree, w.place, w.level + 1, w.pos // 3 FROM walk w WHERE w.level < 40),
steps AS (
  SELECT w.tree, w.place, w.level AS step, coalesce(string_agg(g.digest, '' ORDER BY g.place) FILTER (g.place < w.pos), '') AS before,
    coalesce(string_agg(g.digest, '' ORDER BY g.place) FILTER (g.place > w.pos), '') AS after
  FROM walk w JOIN g ON g.tree = w.tree AND g.level = w.level AND g.place // 3 = w.pos // 3 WHERE g.size > 1 GROUP BY 1, 2, 3),
top_walk(tree, level, pos) AS (
  SELECT DISTINCT tree, 0, tree FROM r
  UNION ALL
  SELECT w.tree, w.level + 1, w.pos // 3 FROM top_walk w WHERE w.level < 40),
top_steps AS (
  SELECT w.tree, w.level + 100 AS step, coalesce(string_agg(t.digest, '' ORDER BY t.place) FILTER (t.place < w.pos), '') AS before,
    coalesce(string_agg(t.digest, '' ORDER BY t.place) FILTER (t.place > w.pos), '') AS after
  FROM top_walk w JOIN t ON t.level = w.level AND t.place // 3 = w.pos // 3 WHERE t.size > 1 GROUP BY 1, 2),
paths AS (
  SELECT tree, place, step, before, after FROM steps
  UNION ALL SELECT r.tree, r.place, step, before, after FROM r JOIN top_steps USING (tree)),
p AS (
  SELECT tree, place, list({{'a': before, 'b': after}} ORDER BY step) AS path, string_agg(before || after, '' ORDER BY step) AS siblings
  FROM paths GROUP BY 1, 2),
f(tree, place, step, digest) AS (
  SELECT tree, place, 0, coalesce(tampered, leaf) FROM r
  UNION ALL
  SELECT f.tree, f.place, f.step + 1, sha256(p.path[f.step + 1].a || f.digest || p.path[f.step + 1].b)
  FROM f JOIN p ON p.tree = f.tree AND p.place = f.place WHERE f.step < len(p.path)),
fold AS (SELECT tree, place, arg_max(digest, step) AS folded FROM f GROUP BY 1, 2),
top AS (SELECT digest AS root FROM t WHERE size = 1)
SELECT r.doc_id, r.leaf, s.digest AS subroot, top.root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
  fold.folded AS folded_root, fold.folded = top.root AS verified
FROM r JOIN (SELECT tree, digest FROM g WHERE size = 1) s USING (tree) JOIN fold USING (tree, place)
LEFT JOIN p USING (tree, place), top
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_embeddings": OP1_EMBEDDINGS,
        "op2_jaccard": OP2_JACCARD,
        "op3_decontamination": OP3_DECONTAMINATION,
        "op4_repeats": OP4_REPEATS,
        "op9_warc": OP9_WARC,
        "op11_ranking": OP11_RANKING,
        "op12_manifest": OP12_MANIFEST,
    }
