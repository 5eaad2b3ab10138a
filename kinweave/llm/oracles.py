"""DuckDB SQL for the corpus queries that SQL can express."""

NEAR_DEDUP = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5_number(array_to_string(w[i:i + 4], ' ') || CASE WHEN len(w) < 5 THEN '#' ELSE '' END) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), both_ways AS MATERIALIZED (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(node, label) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT e.v, r.label FROM reach r JOIN both_ways e ON e.u = r.node WHERE r.label < e.v
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, m.label AS component_id, d.doc_id = m.label AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN (SELECT node, min(label) AS label FROM reach GROUP BY node) m ON m.node = d.doc_id
"""

SECRETS = r"""
WITH cleaned AS (SELECT row_number() OVER () AS r, doc_id, source, translate(coalesce(text, ''), chr(57344) || chr(57345), chr(65533) || chr(65533)) AS t FROM documents),
marked AS (
  SELECT r, doc_id, source, 0 AS k, regexp_replace(t, '((?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?)([A-Za-z0-9+/_.=-]+)', chr(57344) || '\1' || chr(57345) || '\2' || chr(57344), 'g') AS m FROM cleaned
  UNION ALL SELECT r, doc_id, source, 1, regexp_replace(t, '(AKIA)([A-Z0-9]{16,})', chr(57344) || '\1' || chr(57345) || '\2' || chr(57344), 'g') FROM cleaned
  UNION ALL SELECT r, doc_id, source, 2, regexp_replace(t, '()([0-9a-f]{24,})', chr(57344) || '\1' || chr(57345) || '\2' || chr(57344), 'g') FROM cleaned
  UNION ALL SELECT r, doc_id, source, 3, regexp_replace(t, '()([A-Za-z0-9+/_=-]{24,})', chr(57344) || '\1' || chr(57345) || '\2' || chr(57344), 'g') FROM cleaned
), pieces AS (
  SELECT r, doc_id, source, k, string_split(m, chr(57344)) AS p FROM marked WHERE contains(m, chr(57344))
), numbered AS (
  SELECT r, doc_id, source, k, i, p[i] AS v, length(p[i]) - (CASE WHEN i % 2 = 0 THEN 1 ELSE 0 END) AS n
  FROM (SELECT *, unnest(range(1, len(p) + 1)) AS i FROM pieces)
), placed AS (
  SELECT *, sum(n) OVER (PARTITION BY r, k ORDER BY i) AS e, string_split(v, chr(57345)) AS g FROM numbered
), valued AS (
  SELECT r, doc_id, source, k, (e - n)::BIGINT AS s, e::BIGINT AS e, CASE WHEN k = 0 THEN g[2] ELSE g[1] || g[2] END AS v FROM placed
  WHERE i % 2 = 0 AND (k <> 0 OR length(g[2]) >= 6)
    AND (k <> 3 OR (regexp_matches(g[2], '[0-9]') AND regexp_matches(g[2], '[A-Z]') AND regexp_matches(g[2], '[a-z]')))
), counts AS (SELECT v, count(DISTINCT source) AS owners, count(DISTINCT doc_id) AS repositories FROM valued GROUP BY v),
judged AS (
  SELECT x.*, c.owners >= 5 AND c.repositories >= 5 AS example FROM valued x JOIN counts c USING (v)
), kept AS (
  SELECT j.* FROM judged j
  WHERE k <> 3 OR (NOT example AND NOT EXISTS (SELECT 1 FROM judged b WHERE b.r = j.r AND b.k <> 3 AND b.s < j.e AND j.s < b.e))
), named AS (SELECT *, (['assign', 'access', 'hex', 'generic'])[k + 1] || ':' || s || ':' || e AS span FROM kept)
SELECT c.doc_id,
  count(n.k) FILTER (n.k = 0) AS n_assign, count(n.k) FILTER (n.k = 1) AS n_access, count(n.k) FILTER (n.k = 2) AS n_hex,
  sha256(coalesce(string_agg(n.span, ',' ORDER BY n.s, n.k) FILTER (n.k <> 3), '')) AS base_sha256,
  coalesce(string_agg(n.span, ',' ORDER BY n.s, n.k), '') AS spans,
  count(n.k) FILTER (NOT n.example) AS n_live, count(n.k) FILTER (n.example) AS n_example
FROM cleaned c LEFT JOIN named n ON n.r = c.r GROUP BY c.r, c.doc_id
"""

SPACED_SEEDS = r"""
WITH masks(m, mask) AS (
  SELECT i, (['110110011', '101101101', '111001011'])[i] FROM range(1, 4) t(i)
  UNION ALL SELECT 3 + i, repeat('1', i::INT) FROM range(1, 9) t(i)
  UNION ALL SELECT 11 + i, (['011111111', '111111110'])[i] FROM range(1, 3) t(i)
), items AS (
  SELECT item_id, w, len(w) AS n FROM (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark)
), docs AS (
  SELECT doc_id, w, len(w) AS n FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents)
), used AS (SELECT * FROM masks WHERE m <= 3 OR length(mask) IN (SELECT n FROM items)),  -- the last two only for items of nine
item_seeds AS MATERIALIZED (
  SELECT item_id, i, m || ':' || array_to_string(list_filter(list_transform(range(1, length(mask) + 1), lambda k: CASE WHEN mask[k] = '1' THEN w[i + k] END), lambda x: x IS NOT NULL), ' ') AS key
  FROM (SELECT *, unnest(range(0, n)) AS i FROM items) x JOIN used ON i + length(mask) <= n AND (n >= 9 OR i = 0)
), doc_seeds AS (
  SELECT doc_id, i, m || ':' || array_to_string(list_filter(list_transform(range(1, length(mask) + 1), lambda k: CASE WHEN mask[k] = '1' THEN w[i + k] END), lambda x: x IS NOT NULL), ' ') AS key
  FROM (SELECT *, unnest(range(0, n)) AS i FROM docs) x JOIN used ON i + length(mask) <= n
), hits AS MATERIALIZED (
  SELECT DISTINCT d.doc_id, s.item_id, d.i - s.i AS shift, s.i FROM doc_seeds d JOIN item_seeds s USING (key)
), windows AS (
  SELECT h.doc_id, h.item_id, t.w AS tw, d.w AS dw, shift, least(13, t.n) AS width, t.n,
    unnest(range(least(greatest(0, h.i - 4), least(h.i, t.n - least(13, t.n))), least(h.i, t.n - least(13, t.n)) + 1)) AS s
  FROM hits h JOIN items t USING (item_id) JOIN docs d USING (doc_id)
), found AS (
  SELECT DISTINCT doc_id, item_id FROM windows
  WHERE len(list_filter(range(s, s + width), lambda j: shift + j >= 0 AND dw[shift + j + 1] = tw[j + 1])) >= CASE WHEN n >= 13 THEN 11 WHEN n < 9 THEN n ELSE ceil(n * 11 / 13) END
), lists AS (SELECT doc_id, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS item_ids FROM found GROUP BY doc_id)
SELECT d.doc_id, l.doc_id IS NOT NULL AS contaminated, coalesce(l.n, 0)::BIGINT AS n_items, coalesce(l.item_ids, '') AS item_ids
FROM documents d LEFT JOIN lists l USING (doc_id)
"""
