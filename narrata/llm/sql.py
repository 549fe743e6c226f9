"""DuckDB twins of the queries that SQL can express."""

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

WEB_ARCHIVE = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, url, h, sha1(h) AS s, min(page_id) OVER (PARTITION BY h) AS f FROM p)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda b:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(s, (5 * i + 1)::INT, 5))::INT >> b::INT) & 31) + 1, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> f THEN f END AS refers_to, replace(replace(url, chr(13), '%0D'), chr(10), '%0A') AS url
FROM d"""

DECONTAMINATE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s AS x JOIN s AS y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pairs JOIN n AS p ON p.doc_id = a JOIN n AS q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least_id AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM least_id LEFT JOIN n USING (doc_id)"""

#: Unsigned CRC-32 of a short ASCII string, bit by bit.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten([[(ascii(c) >> b) & 1 for b in range(8)] for c in string_split({0}, '')])),
  lambda s, b: xor(s >> 1, CASE WHEN xor(s & 1, b) = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"""

_VALUE = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_VALUE.format(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"

MANIFEST = f"""
WITH RECURSIVE d AS (SELECT *, row_number() OVER () AS r, CASE WHEN ({CRC32.format("doc_id::VARCHAR")}) % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS m FROM documents),
leaves AS (SELECT r, doc_id, coalesce('=' || lang, '') AS t, {_LEAF.format(n="n_chars")} AS leaf, {_LEAF.format(n="m")} AS other FROM d),
placed AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i, count(*) OVER (PARTITION BY t) AS n FROM leaves),
node AS (SELECT t, 0 AS lvl, i, n, leaf AS h FROM placed
  UNION ALL SELECT t, lvl + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY i)) FROM node WHERE n > 1 GROUP BY t, lvl, i // 2),
sub AS (SELECT t, h, lvl AS depth, row_number() OVER (ORDER BY encode(t)) - 1 AS i, count(*) OVER () AS n FROM node WHERE n = 1),
high AS (SELECT 0 AS lvl, i, n, h FROM sub
  UNION ALL SELECT lvl + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY lvl, i // 2),
steps AS (SELECT p.r, node.lvl, node.i, node.h FROM placed AS p JOIN node ON p.t = node.t AND node.n > 1 AND node.i = xor(p.i >> node.lvl, 1)
  UNION ALL SELECT p.r, sub.depth + high.lvl, high.i, high.h FROM placed AS p JOIN sub ON p.t = sub.t JOIN high ON high.n > 1 AND high.i = xor(sub.i >> high.lvl, 1)),
proofs AS (SELECT r, sha256(string_agg(h, '' ORDER BY lvl)) AS proof FROM steps GROUP BY r),
levels AS (SELECT p.r, k.lvl, CASE WHEN k.lvl < sub.depth THEN p.i >> k.lvl ELSE sub.i >> (k.lvl - sub.depth) END AS mine
  FROM placed AS p JOIN sub ON p.t = sub.t, (SELECT unnest(range(64)) AS lvl) AS k WHERE k.lvl < sub.depth + (SELECT max(lvl) FROM high)),
fold AS (SELECT r, 0 AS lvl, other AS h FROM placed
  UNION ALL SELECT fold.r, fold.lvl + 1, sha256(CASE WHEN s.h IS NULL THEN fold.h WHEN s.i < levels.mine THEN s.h || fold.h ELSE fold.h || s.h END)
  FROM fold JOIN levels ON fold.r = levels.r AND fold.lvl = levels.lvl LEFT JOIN steps AS s ON s.r = fold.r AND s.lvl = fold.lvl),
ends AS (SELECT r, arg_max(h, lvl) AS h FROM fold GROUP BY r)
SELECT p.doc_id, p.leaf, sub.h AS subroot, root.h AS root, coalesce(proof, sha256('')) AS proof_sha256, ends.h AS folded_root, ends.h = root.h AS verified
FROM placed AS p JOIN sub ON p.t = sub.t JOIN ends ON p.r = ends.r LEFT JOIN proofs ON p.r = proofs.r, (SELECT h FROM high WHERE n = 1) AS root"""

PERIODIC_RUNS = rf"""
WITH c AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {CRC32.format("doc_id::VARCHAR")} AS h FROM documents),
a AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM c),
d AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_concat(w[1:a], [w[a + 1 + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8))] for i in range(a, n)]) END AS w FROM a),
words AS (SELECT r, unnest(w) AS x, unnest(range(n)) AS i FROM d),
six AS (SELECT r, i, g FROM (SELECT r, unnest(range(n - 5)) AS i, unnest([array_to_string(w[k + 1:k + 6], ' ') for k in range(n - 5)]) AS g FROM d WHERE n >= 12)),
pairs AS (SELECT x.r, x.i, y.i - x.i AS q FROM six AS x JOIN six AS y ON x.r = y.r AND x.g = y.g AND x.i < y.i),
stretch AS (SELECT r, q, min(i) AS s, count(*) + 5 + q AS l FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM pairs) GROUP BY r, q, k),
runs AS (SELECT r, s, l, min(q) AS q FROM stretch WHERE l >= greatest(12, 2 * q) GROUP BY r, s, l),
said AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines, min({{'l': -l, 's': s, 'q': q}}) AS m FROM runs GROUP BY r),
dropped AS (SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS t FROM words ANTI JOIN dropped USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, m.s::BIGINT AS start, -m.l::BIGINT AS length, m.q::BIGINT AS period,
  (1000 * -m.l // m.q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM d LEFT JOIN said USING (r) LEFT JOIN kept USING (r)"""

TWINS = {
    "op2_web_archive": WEB_ARCHIVE, "op9_near_duplicates": NEAR_DUPLICATES, "op10_decontaminate": DECONTAMINATE,
    "op11_manifest": MANIFEST, "op13_periodic_runs": PERIODIC_RUNS}
