"""The operators that SQL can express, as DuckDB statements over the same tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DUPLICATES = rf"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s
  FROM words),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM members a JOIN members b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
sides AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, x.b FROM reached r JOIN sides x ON r.b = x.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# Five hexadecimal digits are four digits of base 32.
_FIVE = [f"CAST('0x' || substr(hex, {1 + 5 * i}, 5) AS INTEGER)" for i in range(8)]
_DIGEST = " || ".join(f"substr('{_BASE32}', (({v} >> {s}) & 31) + 1, 1)" for v in _FIVE for s in (15, 10, 5, 0))

ARCHIVE = f"""WITH pages_hashed AS (
  SELECT page_id, url, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
kept AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS keeper FROM pages_hashed)
SELECT page_id, url, CASE WHEN page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CAST(strlen(payload) AS BIGINT) AS payload_bytes, {_DIGEST} AS payload_digest,
  CASE WHEN page_id < keeper THEN keeper END AS refers_to
FROM kept"""

# crc32 of a decimal number: its digits one by one, eight steps after each.
_CRC = """xor(list_reduce(flatten([[ascii(x), -1, -1, -1, -1, -1, -1, -1, -1] FOR x IN string_split(CAST(c AS VARCHAR), '')]),
    lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END,
    CAST(4294967295 AS BIGINT)), 4294967295)"""

TRIE = rf"""WITH own AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS p,
    coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (SELECT c, count(*) AS n FROM own GROUP BY c),
ids AS (
  SELECT s.c, s.c - s.c % 20 AS leader, {_CRC.replace("(c AS", "(s.c AS")} % 4 AS h, coalesce(l.n, 0) AS there
  FROM sizes s LEFT JOIN sizes l ON l.c = s.c - s.c % 20),
rebuilt AS (
  SELECT i.c, p, r, t FROM ids i JOIN own o ON o.c = i.leader WHERE p < h
  UNION ALL SELECT i.c, p - h + least(h, there), r, t FROM ids i JOIN own o ON o.c = i.c WHERE p >= h),
lists AS (
  SELECT c, list(strlen(r) || ':' || r || t ORDER BY p) AS k,
    list(CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT) ORDER BY p) AS w
  FROM rebuilt GROUP BY c),
whole AS (SELECT c, coalesce(k, []) AS k, coalesce(w, []) AS w FROM ids LEFT JOIN lists USING (c)),
paths AS (
  SELECT c, d, md5(array_to_string(k[1:d], chr(31))) || d AS node,
    CASE WHEN d > 0 THEN md5(array_to_string(k[1:d - 1], chr(31))) || (d - 1) END AS parent,
    CASE WHEN d > 0 THEN w[d] ELSE 0 END AS words, d = len(k) AS ends
  FROM (SELECT *, unnest(range(0, len(k) + 1)) AS d FROM whole)),
nodes AS (
  SELECT node, any_value(d) AS depth, any_value(parent) AS parent, any_value(words) AS words, min(c) AS conv_id,
    count(*) AS n_convs, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '') AS ids
  FROM paths GROUP BY node),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY 1),
below AS (SELECT DISTINCT u.node, v.node AS lower FROM paths u JOIN paths v ON u.c = v.c AND v.d >= u.d),
sums AS (
  SELECT b.node, count(*) FILTER (x.n_children IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
  FROM below b JOIN nodes n ON n.node = b.lower LEFT JOIN children x ON x.node = b.lower GROUP BY b.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
  coalesce(x.n_children, 0) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
  sha256(n.ids) AS ends_sha256
FROM nodes n JOIN sums USING (node) LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN children x ON x.node = n.node"""

REPEATS = """WITH texts AS (SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (  -- 200 bytes, and the 199 after them
  SELECT row, block, substr(h, 400 * block + 1, 798) AS piece
  FROM (SELECT row, h, unnest(range(0, len(h) // 400 + 1)) AS block FROM texts)),
windows AS (
  SELECT row, 200 * block + i AS start, md5(substr(piece, 2 * i + 1, 400)) AS w
  FROM (SELECT *, unnest(range(0, least(200, len(piece) // 2 - 199))) AS i FROM blocks WHERE len(piece) >= 400)),
again AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
hits AS (SELECT row, start FROM windows SEMI JOIN again USING (w)),
marked AS (
  SELECT *, CASE WHEN start <= max(start) OVER (PARTITION BY row ORDER BY start
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 200 THEN 0 ELSE 1 END AS fresh FROM hits),
spans AS (
  SELECT row, number, min(start) AS low, max(start) + 200 AS high
  FROM (SELECT *, sum(fresh) OVER (PARTITION BY row ORDER BY start) AS number FROM marked) GROUP BY row, number),
pieces AS (
  SELECT row, low, high, lag(high, 1, 0) OVER (PARTITION BY row ORDER BY low) AS before FROM spans),
kept AS (
  SELECT t.row, sum(high - low) AS n_removed, count(*) AS n_spans,
    string_agg(substr(h, 2 * before + 1, 2 * (low - before)), '' ORDER BY low)
      || substr(any_value(h), CAST(2 * max(high) + 1 AS BIGINT)) AS rest
  FROM pieces p JOIN texts t ON t.row = p.row GROUP BY t.row)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM texts LEFT JOIN kept USING (row)"""

SQL = {
    "op5_warc_archive": ARCHIVE,
    "op9_minhash_near_dedup": NEAR_DUPLICATES,
    "op11_prefix_trie": TRIE,
    "op12_repeated_strings": REPEATS,
}
