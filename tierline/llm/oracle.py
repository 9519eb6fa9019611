"""DuckDB SQL returning the rows of the registered queries, where SQL can express them on whole tables."""

_W = r"[^\x20\x09-\x0D]+"

_OP3 = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS rn, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.rn, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.rn <> q.rn
)
SELECT query_id, row_number() OVER w::INTEGER AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY rn ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

_OP4 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_W}') AS w FROM documents
), win AS (
  SELECT doc_id, i, w[i:i+4] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), rep AS (
  SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), cov AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, range(5) r(k) GROUP BY doc_id
), lines AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_W}')) AS l FROM d
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN lines USING (doc_id) LEFT JOIN cov USING (doc_id)
), b AS (
  SELECT *, (n_words < 10)::INTEGER + 2 * (100 * n_repeat_words > 20 * n_words)::INTEGER
    + 4 * (word_chars < 2 * n_words)::INTEGER + 8 * (word_chars > 25 * n_words)::INTEGER
    + 16 * (n_symbols > n_words)::INTEGER + 32 * (n_lines >= 4 AND 10 * n_dup_lines > 3 * n_lines)::INTEGER AS failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed,
  failed & 3 <> 0 AS base_failed, failed = 0 AS kept
FROM b
"""

_OP11 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 5
"""

_LAYOUTS = "SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations"

ORACLES = {"chat_layouts": _LAYOUTS, "op11_hard_negatives": _OP11, "op3_topk": _OP3, "op4_quality_rules": _OP4}
