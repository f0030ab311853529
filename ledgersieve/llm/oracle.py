"""The same results in SQL for DuckDB, where SQL can express them at full size."""

from __future__ import annotations

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS draw
  FROM documents
), ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source ASC NULLS LAST) AS turn
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, [3, 1, 2][((turn - 1) % 3 + 1)::INT] AS weight, 2 * source_size AS most FROM ranked
), levels AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::BIGINT - coalesce(sum(most) OVER (
      ORDER BY most::DOUBLE / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
    / (sum(weight) OVER (ORDER BY most::DOUBLE / weight, turn
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
  FROM weighed
), targets AS (
  SELECT *, least(most::DOUBLE, max(level) OVER () * weight) AS target FROM levels
), budgets AS (
  SELECT *, least(most, floor(target + 0.5)::BIGINT) AS budget FROM targets
), placed AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, b.budget,
    CASE WHEN b.source_size = 0 THEN 0 ELSE b.budget // b.source_size END AS epochs,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.draw, s.doc_id, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken
FROM placed
"""

TOP_K = """
WITH used AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM used q JOIN used c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

HARD_NEGATIVES = """
WITH used AS (
  SELECT DISTINCT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, c.vec_id, c.label, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM used a JOIN used c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), found AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
    AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 5
"""

JACCARD = r"""
WITH RECURSIVE cut AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), sets AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s
  FROM cut
), entries AS (
  SELECT r, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
  SELECT a.r AS one, b.r AS other FROM entries a JOIN entries b ON a.shingle = b.shingle AND a.r < b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), both_ways AS (
  SELECT one, other FROM links UNION ALL SELECT other, one FROM links
), reached AS (
  SELECT r AS start, r AS node FROM sets
  UNION
  SELECT reached.start, both_ways.other FROM reached JOIN both_ways ON both_ways.one = reached.node
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM sets s JOIN reached ON reached.start = s.r JOIN sets o ON o.r = reached.node
GROUP BY s.r, s.doc_id, s.s
"""

REPAIR = r"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations
), hashed AS (  -- CRC-32 bit by bit: a byte comes in, then eight shifts
  SELECT *, xor(list_reduce(
      list_concat([4294967295], flatten(list_transform(range(1, length(name) + 1),
        lambda i: list_concat([unicode(substr(name, i::INT, 1))::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1])))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 20 AS kind
  FROM named
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE kind <> 0
), placed AS (
  SELECT *, coalesce(conv_id::VARCHAR, 'null') AS c,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS k,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS solid
  FROM damaged
), judged AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS before,
    CASE WHEN solid = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
      WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed
), inserted(a, b, cost, edits, body) AS (  -- states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant
  VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''), (0, 2, 2, 'I', E'\nuser:'), (1, 2, 2, 'I', E'\nuser:'),
    (3, 2, 2, 'I', E'\nuser:'), (2, 3, 2, 'I', E'\nassistant:'), (0, 3, 4, 'II', E'\nuser:\nassistant:'),
    (1, 3, 4, 'II', E'\nuser:\nassistant:'), (3, 3, 4, 'II', E'\nuser:\nassistant:'), (2, 2, 4, 'II', E'\nassistant:\nuser:')
), follows(a, initial, b) AS (
  VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)
), edited AS (
  SELECT c, k, a, a AS b, 3 AS cost, 'D' AS edit, '' AS body FROM judged, range(4) s(a)
  UNION ALL
  SELECT c, k, f.a, f.b, (CASE fault WHEN 'truncated' THEN 1 ELSE 0 END), 'K', E'\n' || role || ':' || text
  FROM judged JOIN follows f ON f.initial = judged.initial WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT c, k, f.a, f.b, 2 + (CASE fault WHEN 'truncated' THEN 1 ELSE 0 END), 'R',
    E'\n' || (CASE f.initial WHEN 'u' THEN 'user' ELSE 'assistant' END) || ':' || text
  FROM judged JOIN follows f ON f.initial IN ('u', 'a') WHERE fault NOT IN ('blank', 'duplicate')
), steps AS (
  SELECT e.c, e.k, i.a, e.b, i.cost + e.cost AS cost, i.edits || e.edit AS edits, i.body || e.body AS body
  FROM edited e JOIN inserted i ON i.b = e.a
), ways AS (
  SELECT DISTINCT c, 0::BIGINT AS k, 0 AS state, {'cost': 0::BIGINT, 'audit': '', 'body': ''} AS best FROM placed
  UNION ALL
  SELECT w.c, w.k + 1, s.b, min({'cost': w.best.cost + s.cost, 'audit': w.best.audit || s.edits, 'body': w.best.body || s.body})
  FROM ways w JOIN steps s ON s.c = w.c AND s.k = w.k + 1 AND s.a = w.state GROUP BY w.c, w.k, s.b
), ended AS (
  SELECT w.c, min({'cost': w.best.cost + i.cost, 'audit': w.best.audit || i.edits, 'body': w.best.body || i.body}) AS best
  FROM ways w JOIN (SELECT c, max(k) AS last FROM placed GROUP BY c) l ON l.c = w.c AND l.last = w.k
  JOIN inserted i ON i.a = w.state AND (i.b = 3 OR i.b = 0) GROUP BY w.c
), counted AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (k > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY c
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(ended.best.cost, 0)::BIGINT AS cost,
  coalesce(ended.best.audit, '') AS audit, sha256(coalesce(substr(ended.best.body, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, 'null') AS c FROM conversations) e
LEFT JOIN counted USING (c) LEFT JOIN ended USING (c)
"""

ORACLES = {
    "op1_mtree_top_k": TOP_K, "op2_mix_sources": MIXING, "op11_grammar_repair": REPAIR, "op12_threshold_negatives": HARD_NEGATIVES,
    "op13_jaccard_product": JACCARD,
}


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
