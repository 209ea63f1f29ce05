"""DuckDB SQL for those queries that SQL can express."""

from __future__ import annotations

_KEY = "translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_DEDUP = f"""
WITH cut AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM cut
), keyed AS (
  SELECT doc_id, i, line, {_KEY} AS key FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), told AS (
  SELECT k.*, s.keeper IS NOT NULL AND s.keeper <> k.doc_id AS lost FROM keyed k LEFT JOIN shared s USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM told GROUP BY doc_id
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
    AND len(list_filter(embedding, lambda v: v <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.93
), reached AS (
  SELECT a AS v, a AS r FROM links UNION SELECT l.b, reached.r FROM reached JOIN links l ON l.a = reached.v
), least AS (
  SELECT v, min(r) AS r FROM reached GROUP BY v
), counted AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, coalesce(m.r, e.vec_id) AS component_id, coalesce(m.r, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counted c ON c.a = e.vec_id LEFT JOIN least m ON m.v = e.vec_id
"""

ORACLES = {"op1_line_dedup": LINE_DEDUP, "op9_embedding_dedup": EMBEDDING_DEDUP}
