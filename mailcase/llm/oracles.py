"""DuckDB SQL of the operators that SQL can express, over the same tables."""

from __future__ import annotations

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE = {
    "op1_substring_dedup": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, p, list_aggregate(w[p:p + 19], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20)),
again AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY g ORDER BY doc_id, p) AS k FROM win)
  WHERE k > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM again),
word AS (
  SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS q FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY q) AS t
  FROM word ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op2_decontamination": rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
q AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
         list_aggregate(w[p:p + 12], 'string_agg', ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p
        FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM q),
win AS (
  SELECT doc_id, n, p, list_aggregate(w[p:p + n - 1], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, win.p, win.n, item_id FROM win JOIN q ON win.g = q.g AND win.n = q.n),
words AS (
  SELECT doc_id, count(DISTINCT x) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op3_mixing": r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))
                              AS BIGINT) AS size, md5(coalesce(text, '')) AS tid FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (
  SELECT source, source_size, 3.0 * CAST(source_size AS DOUBLE) AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS k FROM r),
x AS (
  SELECT k, cap, w,
         ((SELECT CAST(sum(source_size) AS DOUBLE) FROM s)
          - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o),
l AS (SELECT level FROM x WHERE level * w <= cap ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least(w * (SELECT level FROM l), cap) AS target FROM r),
j AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size = 0 THEN 0.0 ELSE t.target / t.source_size END AS rate,
         CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '') || ':17:' || d.tid), 1, 13) AS BIGINT)
           / 4503599627370496.0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM j""",
    "op5_exact_dedup": f"""
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), {_AZ}) AS t FROM documents)""",
    "op10_line_dedup": f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (
  SELECT doc_id, line, p, translate(trim(line, {_SPACE}), {_AZ}) AS k
  FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS p FROM d)),
rep AS (
  SELECT k, max(doc_id) AS last FROM l WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT l.*, rep.last FROM l LEFT JOIN rep ON l.k = rep.k),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY p) AS t
  FROM m WHERE last IS NULL OR last = doc_id GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ls) AS BIGINT) AS n_lines,
       CAST(len(ls) - coalesce(n, 0) AS BIGINT) AS n_dropped, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op12_lexical_search": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all(
    translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
item AS (SELECT q, item_id, term, count(*) AS c FROM (SELECT q, item_id, unnest(w) AS term FROM b) GROUP BY ALL),
size AS (SELECT count(*) FILTER (len(w) > 0) AS n_all, CAST(sum(len(w)) AS BIGINT) AS l_all FROM d),
hit AS (
  SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM item) GROUP BY ALL),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_all + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM hit GROUP BY term), size),
score AS (
  SELECT q, item_id, r, doc_id,
         CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_all) // l_all)))))
              AS BIGINT) AS score
  FROM hit JOIN weight USING (term) JOIN item USING (term), size GROUP BY q, item_id, r, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id, r) AS rank
  FROM score WHERE score > 0)
WHERE rank <= 20"""}
