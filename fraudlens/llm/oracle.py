"""DuckDB SQL for the rows of the corpus queries that SQL can express."""

# ---- benchmark decontamination: every window of every item against every window of every document
_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_OP2 = rf"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
item AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS g, least(10, len(w)) AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM win),
spot AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
hit AS (SELECT DISTINCT doc_id, i, spot.k, item_id FROM spot JOIN win USING (g)),
word AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(word.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256, word.n IS NOT NULL AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# ---- n-gram Jaccard join: overlap of every pair that shares a shingle, then reachability
_OP4 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
link AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN size sa ON sa.doc_id = a.doc_id JOIN size sb ON sb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, sa.n, sb.n
  HAVING 100 * count(*) >= 75 * (sa.n + sb.n - count(*))),
reach AS (SELECT DISTINCT x AS doc_id, x AS other FROM link
          UNION SELECT reach.doc_id, link.y FROM reach JOIN link ON link.x = reach.other)
SELECT d.doc_id, coalesce(any_value(size.n), 0) AS n_shingles, least(d.doc_id, coalesce(min(reach.other), d.doc_id)) AS component_id
FROM d LEFT JOIN size USING (doc_id) LEFT JOIN reach ON reach.doc_id = d.doc_id GROUP BY d.doc_id
"""

# ---- line dedup: similarity of every pair of distinct sets that share one of their rarest words
_OP1 = r"""
WITH line AS MATERIALIZED (
  SELECT doc_id, i AS line_no, ls[i + 1] AS line
  FROM (SELECT doc_id, ls, unnest(range(0, len(ls))) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
bag AS MATERIALIZED (
  SELECT doc_id, line_no, line, list_sort(list_distinct(regexp_extract_all(lower(line), '[^ \t\r\x0b\x0c]+'))) AS s FROM line),
class AS MATERIALIZED (
  SELECT s, len(s) AS n, min((doc_id, line_no)) AS head, row_number() OVER () AS id FROM bag WHERE len(s) > 0 GROUP BY s),
word AS (SELECT w, count(*) AS c FROM (SELECT unnest(s) AS w FROM class) GROUP BY 1),
front AS MATERIALIZED (
  SELECT id, n, head, w FROM (SELECT id, n, head, unnest(s) AS w FROM class) JOIN word USING (w)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY c, w) <= n - (75 * n + 99) // 100 + 1),
pair AS (
  SELECT DISTINCT a.id AS x, b.id AS y FROM front a JOIN front b ON a.w = b.w AND b.head < a.head
  AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)),
late AS (
  SELECT DISTINCT x FROM pair JOIN class a ON a.id = x JOIN class b ON b.id = y
  WHERE 175 * len(list_intersect(a.s, b.s)) >= 75 * (a.n + b.n)),
fate AS (
  SELECT doc_id, line_no, line, head IS NOT NULL AND (head <> (doc_id, line_no) OR id IN (SELECT x FROM late)) AS gone
  FROM bag LEFT JOIN class USING (s))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       coalesce(string_agg(line_no::VARCHAR, ',' ORDER BY line_no) FILTER (gone), '') AS removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '')) AS text_sha256
FROM fate GROUP BY doc_id
"""

# ---- filter audit: every order of the filters over counts by part and set of failed filters
_OP13 = r"""
WITH first AS (SELECT coalesce(text, '') AS t, min(doc_id) AS lo FROM documents GROUP BY 1),
d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, lo,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents JOIN first ON first.t = coalesce(text, '')),
mark AS (SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic FROM labels GROUP BY 1),
judged AS (
  SELECT part, concat(if(len(w) < 50, 'A', ''), if(100 * len(list_distinct(w)) < 65 * len(w), 'B', ''),
                      if(100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t), 'C', ''),
                      if(regexp_matches(t, '[#$%&*|]'), 'D', ''), if(coalesce(d.doc_id > lo, false), 'E', '')) AS bad,
         coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM d LEFT JOIN mark ON mark.doc_id = d.doc_id),
cell AS (SELECT part, bad, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY 1, 2),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT concat(a.f, b.f, c.f, d.f, e.f) AS o FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
step AS (SELECT o, k, o[k] AS f, substr(o, 1, k - 1) AS before FROM orders, range(1, 6) t(k)),
found AS (
  SELECT part, o AS filter_order, k::INT AS step, f,
         sum(if(translate(bad, before || f, '') = bad, n, 0)) AS kept,
         sum(if(translate(bad, before, '') = bad AND contains(bad, f), n, 0)) AS removed,
         sum(if(translate(bad, before, '') <> bad AND contains(bad, f), n, 0)) AS redundant,
         sum(if(bad = f, n, 0)) AS unique_fails,
         sum(if(translate(bad, before, '') = bad AND contains(bad, f), good, 0)) AS good_lost,
         sum(if(translate(bad, before, '') = bad AND contains(bad, f), toxic, 0)) AS toxic_lost
  FROM cell, step GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM found
"""

# ---- repeated passages: every 50-byte string (as hexadecimal digits) with the smallest id that holds it
_OP11 = r"""
WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS t FROM documents),
win AS MATERIALIZED (SELECT doc_id, x, substr(t, 2 * x + 1, 100) AS s FROM (SELECT doc_id, t, unnest(range(0, len(t) // 2 - 49)) AS x FROM d)),
least AS MATERIALIZED (SELECT s, min(doc_id) AS lo FROM win GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, x FROM win JOIN least USING (s) WHERE doc_id > lo),
edge AS (SELECT doc_id, x, coalesce(x > lag(x) OVER w + 50, true) AS new FROM gone WINDOW w AS (PARTITION BY doc_id ORDER BY x)),
span AS (
  SELECT doc_id, k, min(x) AS a, max(x) + 50 AS b
  FROM (SELECT doc_id, x, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY x) AS k FROM edge) GROUP BY 1, 2),
piece AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM span),
cut AS (
  SELECT doc_id, sum(b - a) AS n, count(*) AS c, string_agg(substr(t, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS head, max(b) AS last
  FROM piece JOIN d USING (doc_id) GROUP BY 1)
SELECT d.doc_id, len(t) // 2 AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(c, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(t, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

ORACLE = {
    "op11_suffix_dedup": _OP11,
    "op13_filter_audit": _OP13,
    "op1_line_dedup": _OP1,
    "op2_decontamination": _OP2,
    "op4_ngram_join": _OP4,
    "op9_exact_dedup": """
SELECT d.doc_id, g.keep_id, g.n AS group_size, d.doc_id = g.keep_id AS kept, sha256(coalesce(d.text, '')) AS text_sha256
FROM documents d
JOIN (SELECT coalesce(text, '') AS t, max(doc_id) AS keep_id, count(*) AS n FROM documents GROUP BY 1) g
  ON g.t = coalesce(d.text, '')
""",
}
