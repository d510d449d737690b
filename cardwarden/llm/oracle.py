"""DuckDB twins of the queries that SQL can express, on the same tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_VECTORS = """
WITH RECURSIVE given AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), usable AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM given
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_dot_product(e, e) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
    ON x.label = y.label AND len(x.e) = len(y.e) AND x.vec_id <> y.vec_id
  WHERE list_dot_product(x.e, y.e) / (x.norm * y.norm) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM given
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM given JOIN least ON least.a = vec_id LEFT JOIN counts ON counts.a = vec_id
"""

_ESCAPED = "replace({0}, chr(92), chr(92) || chr(92))"
for _control in ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]"):
    _ESCAPED = f"replace({_ESCAPED}, '{_control}', '{_control[0]}' || chr(92) || '{_control[1:]}')"

_CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), said AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(33 + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}))::BIGINT AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM said
"""

_OVERLAP = f"""
WITH item AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, n, w[k : k + n - 1] AS words
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM (SELECT *, least(10, len(w)) AS n FROM item WHERE len(w) > 0))
), doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), place AS (
  SELECT r, n, k, w[k : k + n - 1] AS words
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM doc, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), found AS (SELECT r, k, place.n, item_id FROM place JOIN windows ON place.n = windows.n AND place.words = windows.words),
hits AS (SELECT r, count(DISTINCT spot) AS n FROM (SELECT r, unnest(range(k, k + n)) AS spot FROM found) GROUP BY r),
names AS (
  SELECT r, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS name FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hits.n, 0)::BIGINT AS n_hit, coalesce(names.n, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN hits USING (r) LEFT JOIN names USING (r)
"""

_NEAR = f"""
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingle AS (
  SELECT DISTINCT r, w[k : k + n - 1] AS s
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM (SELECT *, least(5, len(w)) AS n FROM doc WHERE len(w) > 0))
), size AS (SELECT r, count(*) AS n FROM shingle GROUP BY r),
common AS (
  SELECT x.r AS a, y.r AS b, count(*) AS n FROM shingle x JOIN shingle y ON x.s = y.s AND x.r <> y.r GROUP BY x.r, y.r
), links AS (
  SELECT a, b FROM common JOIN size p ON p.r = a JOIN size q ON q.r = b WHERE 100 * common.n >= 85 * (p.n + q.n - common.n)
), reach AS (
  SELECT r AS a, r AS b FROM doc
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT a, min(doc_id) AS component_id FROM reach JOIN doc ON doc.r = b GROUP BY a)
SELECT doc_id, coalesce(size.n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM doc JOIN least ON least.a = doc.r LEFT JOIN size ON size.r = doc.r
"""

SQL: dict[str, str] = {
    "op2_vector_near_duplicates": _VECTORS,
    "op3_chat_format": _CHAT,
    "op6_benchmark_overlap": _OVERLAP,
    "op7_near_duplicates": _NEAR,
}
