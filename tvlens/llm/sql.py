"""DuckDB SQL for the opN_ queries that SQL can express."""

from __future__ import annotations

_MIX = r"""
WITH d AS (
  SELECT doc_id, source, text,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '')) AS size,
         CAST('0x' || substr(md5(concat_ws('|', CAST(doc_id AS VARCHAR), text)), 1, 15) AS BIGINT) AS h
  FROM documents
),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rk
  FROM d GROUP BY source
),
w AS (SELECT *, 1 + rk % 3 AS weight, 3 * source_size AS cap FROM s),
lv AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM w WINDOW o AS (ORDER BY cap::DOUBLE / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
t AS (
  SELECT source, source_size,
         CASE WHEN cap > weight * (SELECT max(level) FROM lv WHERE cap::DOUBLE / weight > level)
              THEN weight * (SELECT max(level) FROM lv WHERE cap::DOUBLE / weight > level)
              ELSE cap::DOUBLE END AS target
  FROM lv
),
g AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS copies FROM t
),
runs AS (
  SELECT x.source, x.h, x.size, sum(x.size) OVER (PARTITION BY x.source ORDER BY x.h) - x.size AS below,
         g.target - g.copies * g.source_size AS room
  FROM (SELECT source, h, sum(size) AS size FROM d WHERE size > 0 GROUP BY source, h) x
  JOIN g ON x.source IS NOT DISTINCT FROM g.source
),
extra AS (
  SELECT source, h FROM runs
  WHERE below + size <= room OR (below <= room AND below + size - room <= room - below)
)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, g.source_size, round(g.target, 6) AS target,
       CAST(d.size * (g.copies + CASE WHEN e.h IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS taken
FROM d
JOIN g ON d.source IS NOT DISTINCT FROM g.source
LEFT JOIN extra e ON d.h = e.h AND d.source IS NOT DISTINCT FROM e.source
"""

_RULES = r"""
WITH d AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines
  FROM documents
),
p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
t AS (
  SELECT doc_id, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS tri
  FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
r AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, tri) AS n FROM t WHERE tri IS NOT NULL), range(3) AS s(k)
  WHERE n > 1 GROUP BY doc_id
),
f AS (
  SELECT doc_id, host, len(w) AS n_words, coalesce(length(array_to_string(w, '')), 0) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN r USING (doc_id)
),
j AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         10 * n_symbols > n_words AS f_symbols, n_dup_lines * 20 > n_words AS f_lines,
         word_chars < 2 * n_words OR word_chars > 15 * n_words AS f_length
  FROM f
),
h AS (
  SELECT host, rule, count(*)::DOUBLE AS n, sum(bad::INT)::DOUBLE AS k
  FROM (
    SELECT host, unnest(['base', 'symbols', 'lines', 'length']) AS rule,
           unnest([base_failed, f_symbols, f_lines, f_length]) AS bad
    FROM j WHERE host IS NOT NULL
  ) GROUP BY host, rule
),
m AS (SELECT rule, sum(k) / sum(n) AS mean, sum(k * k / n) / sum(n) - (sum(k) / sum(n)) * (sum(k) / sum(n)) AS spread FROM h GROUP BY rule),
st AS (
  SELECT rule, mean,
         CASE WHEN spread * 1001 > mean * (1 - mean) THEN greatest(mean * (1 - mean) / spread - 1, 1.0) ELSE 1000.0 END AS s
  FROM m
),
v AS (SELECT host, max((k + s * mean) / (n + s)) <= 0.5 AS host_ok FROM h JOIN st USING (rule) GROUP BY host)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND coalesce(host_ok, true) AS kept
FROM j LEFT JOIN v USING (host)
"""

_NEGATIVES = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
),
n AS (
  SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INT) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

_AUDIT = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS w
  FROM documents
),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS bits,
         coalesce(good, false)::INT AS good, coalesce(toxic, false)::INT AS toxic
  FROM d LEFT JOIN l USING (doc_id)
),
c AS (SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, bits),
k AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM k a, k b, k c, k d, k e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
),
s AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM o, range(1, 6) AS r(step)
),
a AS (
  SELECT part, filter_order, step, any_value(bit) AS bit,
         coalesce(sum(n) FILTER (bits & (before | bit) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (bits & before = 0 AND bits & bit <> 0), 0) AS removed,
         coalesce(sum(n) FILTER (bits & before <> 0 AND bits & bit <> 0), 0) AS redundant,
         coalesce(sum(n) FILTER (bits = bit), 0) AS unique_fails,
         coalesce(sum(good) FILTER (bits & before = 0 AND bits & bit <> 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (bits & before = 0 AND bits & bit <> 0), 0) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step
)
SELECT part, filter_order, CAST(step AS INT) AS step, substr(filter_order, CAST(step AS INT), 1) AS filter,
       CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM a
"""

SQL: dict[str, str] = {"op4_host_rules": _RULES, "op5_mix_sources": _MIX, "op11_hard_negatives": _NEGATIVES, "op12_filter_audit": _AUDIT}
