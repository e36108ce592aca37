"""DuckDB SQL of the training-data queries that SQL can express."""

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORDS = rf"list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SEPARATORS}'), lambda w: w <> '')"

ORACLE = {}

ORACLE["op1_decontaminate"] = f"""
WITH item_words AS (SELECT item_id, {WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, list_slice(w, s, s + 9) AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM item_words WHERE len(w) > 0)),
doc_words AS (SELECT doc_id, coalesce({WORDS}, []) AS w FROM documents),
places AS (
  SELECT doc_id, s, l, list_slice(w, s, s + l - 1) AS win
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS s
        FROM doc_words, (SELECT DISTINCT len(win) AS l FROM windows) WHERE len(w) >= l)),
hits AS (SELECT DISTINCT p.doc_id, p.s, p.l, x.item_id FROM places p JOIN windows x USING (win)),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + l)) AS place FROM (SELECT DISTINCT doc_id, s, l FROM hits)) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

ORACLE["op4_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest FROM p),
w AS (SELECT payload_digest, max(page_id) AS kept FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < kept THEN kept END AS refers_to
FROM d LEFT JOIN w USING (payload_digest)
"""

ORACLE["op6_url_lists"] = r"""
WITH parts AS (
  SELECT page_id, url, string_split(translate(substr(trim(url), strpos(url, '://') + 3), '\', '/'), '#')[1] AS rest
  FROM pages WHERE regexp_matches(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://')),
located AS (
  SELECT page_id, string_split(rest, '?')[1] AS place FROM parts),
named AS (
  SELECT page_id, string_split(place, '/')[1] AS authority, list_filter(list_slice(string_split(place, '/'), 2, 1000000), lambda x: x <> '') AS steps FROM located),
hosts AS (
  SELECT page_id, steps, rtrim(lower(string_split(list_extract(string_split(authority, '@'), -1), ':')[1]), '.') AS host FROM named),
cap AS (
  SELECT p.page_id, p.url, DATE '2024-01-01' + CAST((p.page_id * 7919 + 13) % 366 AS INTEGER) AS day, coalesce(host, '') AS host, coalesce(steps, []) AS steps
  FROM pages p LEFT JOIN (SELECT DISTINCT * FROM hosts) h ON h.page_id = p.page_id),
keys AS (
  SELECT DISTINCT 'h' AS kind, host AS key FROM cap WHERE host <> ''
  UNION ALL SELECT DISTINCT 'p', host || '/' || steps[1] FROM cap WHERE host <> '' AND len(steps) > 0),
num AS (
  SELECT kind, key, CAST('0x' || substr(md5(key), 1, 4) AS INTEGER) AS h, CAST('0x' || substr(md5(key), 5, 4) AS INTEGER) % 90 + 1 AS gap,
         CAST('0x' || substr(md5(key), 9, 4) AS INTEGER) % 300 AS first
  FROM keys),
picked AS (
  SELECT 'block' AS list, * FROM num WHERE kind = 'h' AND h % 3 = 0
  UNION ALL SELECT 'allow', * FROM num WHERE kind = 'p' AND h % 5 = 0
  UNION ALL SELECT 'block', * FROM num WHERE kind = 'p' AND h % 7 = 0),
entries AS (
  SELECT list, key, 'add' AS action, DATE '2024-01-01' + first AS day FROM picked
  UNION ALL SELECT list, key, 'remove', DATE '2024-01-01' + (first + gap) FROM picked WHERE h % 2 = 0
  UNION ALL SELECT list, key, 'add', DATE '2024-01-01' + (first + gap + 20) FROM picked WHERE h % 4 = 0),
spans AS (
  SELECT list, key, action, day AS since, lead(day) OVER (PARTITION BY list, key ORDER BY day) AS until FROM entries),
wanted AS (
  SELECT page_id, day, i AS rank, list_aggregate(list_slice(labels, len(labels) - i + 1, len(labels)), 'string_agg', '.') AS key
  FROM (SELECT page_id, day, string_split(host, '.') AS labels, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM cap WHERE host <> '')
  UNION ALL
  SELECT page_id, day, 100 + i, host || '/' || list_aggregate(list_slice(steps, 1, i), 'string_agg', '/')
  FROM (SELECT page_id, day, host, steps, unnest(range(1, least(len(steps), 3) + 1)) AS i FROM cap WHERE host <> '')),
hits AS (
  SELECT w.page_id, w.rank, s.key, s.list, s.since,
         row_number() OVER (PARTITION BY w.page_id ORDER BY w.rank DESC, s.list DESC) AS nth
  FROM wanted w JOIN spans s ON s.key = w.key AND s.action = 'add' AND s.since <= w.day AND (s.until IS NULL OR w.day < s.until))
SELECT page_id, key AS matched_key, list AS matched_list, CAST(since AS VARCHAR) AS listed_from, coalesce(list = 'block', false) AS blocked
FROM cap LEFT JOIN (SELECT * FROM hits WHERE nth = 1) USING (page_id)
"""

ORACLE["op8_near_dup"] = r"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS sh
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM doc_words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingles a JOIN shingles b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * common >= 80 * (p.n + q.n - common)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(doc_id, seen) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT e.y, r.seen FROM reach r JOIN edges e ON e.x = r.doc_id WHERE r.seen < e.y),
least AS (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) JOIN least USING (doc_id)
"""

ORACLE["op11_hard_negatives"] = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, v.vec_id AS other, a.label = v.label AS same,
         CAST(list_sum(list_transform(list_zip(a.q, v.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS nth FROM scores WHERE same) WHERE nth <= 5),
negatives AS (
  SELECT p.anchor_id, p.positive_id, s.other AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS nth
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, CAST(nth AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE nth <= 5
"""

ORACLE["op12_fill_in_middle"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
x AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
parts AS (
  SELECT *, substr(t, 1, least(a, b)) AS p, substr(t, least(a, b) + 1, greatest(a, b) - least(a, b)) AS m, substr(t, greatest(a, b) + 1, n) AS s FROM x)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN greatest(a, b) - least(a, b) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

_LIMITS = {5: 0.30, 6: 0.28, 8: 0.26, 10: 0.24}      # shares of word characters, as the rules have them

ORACLE["op5_repetition"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
places AS (SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
five AS (SELECT doc_id, s, list_slice(w, s, s + 4) AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS s FROM d WHERE len(w) >= 5)),
seeds AS (SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, win) AS c FROM five) WHERE c > 1),
longer AS (
  SELECT doc_id, n, s, list_slice(w, s, s + n - 1) AS win
  FROM (SELECT seeds.doc_id, s, w, unnest([6, 8, 10]) AS n FROM seeds JOIN d ON d.doc_id = seeds.doc_id) WHERE s + n - 1 <= len(w)),
again AS (
  SELECT doc_id, 5 AS n, s FROM seeds
  UNION ALL SELECT doc_id, n, s FROM (SELECT doc_id, n, s, count(*) OVER (PARTITION BY doc_id, n, win) AS c FROM longer) WHERE c > 1),
covered AS (SELECT DISTINCT doc_id, n, p FROM (SELECT doc_id, n, unnest(range(s, s + n)) AS p FROM again)),
dup AS (
  SELECT c.doc_id, count(*) FILTER (WHERE n = 8) AS repeat_words, """ + ", ".join(
    f"coalesce(sum(length(word)) FILTER (WHERE n = {n}), 0) AS c{n}" for n in _LIMITS) + r"""
  FROM covered c JOIN places p ON p.doc_id = c.doc_id AND p.i = c.p GROUP BY c.doc_id),
split AS (SELECT doc_id, string_split(t, chr(10)) AS parts FROM d),
lines AS (SELECT doc_id, nr, parts[nr] AS line FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS nr FROM split)),
old AS (
  SELECT doc_id, count(*) AS n, sum(length(line)) AS chars
  FROM (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY nr) AS nth FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]'))
  WHERE nth > 1 GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(t) AS BIGINT) AS chars, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(coalesce(o.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(o.chars, 0) AS BIGINT) AS dup_line_chars, """ + ", ".join(
    f"CAST(coalesce(c{n}, 0) AS BIGINT) AS dup_{n}gram_chars" for n in _LIMITS) + r"""
  FROM d LEFT JOIN dup ON dup.doc_id = d.doc_id LEFT JOIN old o ON o.doc_id = d.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, dup_line_chars, """ + ", ".join(f"dup_{n}gram_chars" for n in _LIMITS) + """,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR dup_line_chars > CAST(0.3 AS DOUBLE) * greatest(chars, 1)""" + "".join(
    f" OR dup_{n}gram_chars > CAST({limit} AS DOUBLE) * greatest(word_chars, 1)" for n, limit in _LIMITS.items()) + """) AS kept
FROM m
"""
