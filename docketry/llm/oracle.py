"""DuckDB SQL of the operators that SQL can express, over whole tables."""

OP6 = r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
cut AS (SELECT r, doc_id, coalesce('s' || source, 'null') AS site, text, string_split(text, chr(10)) AS lines FROM doc),
one AS (
  SELECT r, site, unnest(lines) AS raw, generate_subscripts(lines, 1) AS i FROM cut
),
solid AS (
  SELECT r, site, trim(raw, E' \t\n\x0b\x0c\r') AS line FROM one WHERE length(trim(raw, E' \t\n\x0b\x0c\r')) > 0
),
spread AS (SELECT line FROM solid GROUP BY line HAVING count(DISTINCT site) >= 8),
own AS (SELECT r FROM solid LEFT JOIN spread ON solid.line = spread.line GROUP BY r HAVING 2 * count(spread.line) <= count(*)),
bad AS (
  SELECT line FROM solid JOIN own USING (r) JOIN spread USING (line) GROUP BY line HAVING count(DISTINCT site) >= 8
),
kept AS (
  SELECT r, count(*) AS n, count(bad.line) AS n_cut, string_agg(raw, chr(10) ORDER BY i) FILTER (WHERE bad.line IS NULL) AS left_text
  FROM one LEFT JOIN bad ON trim(raw, E' \t\n\x0b\x0c\r') = bad.line GROUP BY r
)
SELECT doc_id, CAST(n AS BIGINT) AS n_lines, CAST(n_cut AS BIGINT) AS n_cut, sha256(coalesce(left_text, '')) AS text_sha256
FROM kept JOIN doc USING (r)
"""

OP7 = r"""
WITH low AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
win AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM item WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM win),
spot AS (
  SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM low, sizes WHERE len(w) >= n)
),
hit AS (SELECT r, s, n, item FROM spot JOIN win USING (n, win)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
named AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM low LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

OP3 = r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
spot AS (
  SELECT r, s, array_to_string(w[s:s + 34], ' ') AS win
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS s FROM doc WHERE len(w) >= 35)
),
twice AS (SELECT win FROM spot GROUP BY win HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(s, s + 35)) AS p FROM spot JOIN twice USING (win)),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM doc),
kept AS (
  SELECT r, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE gone.p IS NULL) AS left_words
  FROM words LEFT JOIN gone USING (r, p) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(left_words, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)
"""

OP11 = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM benchmark
),
asked AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, unnest(t) AS term FROM item) GROUP BY ALL),
total AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM doc WHERE len(t) > 0),
tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM doc) WHERE term IN (SELECT term FROM asked) GROUP BY ALL
),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, n),
part AS (
  SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * len(t) * n) // l)))) AS s
  FROM tf JOIN weight USING (term) JOIN doc USING (r), total
),
score AS (SELECT item_id, r, CAST(sum(c * s) AS BIGINT) AS score FROM asked JOIN part USING (term) GROUP BY ALL HAVING sum(c * s) > 0),
best AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM score JOIN doc USING (r)
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM best WHERE rank <= 20
"""

OP12 = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
score AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM score) WHERE rank <= 20
"""

OP13 = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
score AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM score WHERE same) WHERE place <= 5
),
ranked AS (
  SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
  FROM positive JOIN score USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""

SQL = {
    "op3_substring_dedup": OP3,
    "op6_line_dedup": OP6,
    "op7_decontamination": OP7,
    "op11_ranked_search": OP11,
    "op12_exact_topk": OP12,
    "op13_hard_negatives": OP13,
}
