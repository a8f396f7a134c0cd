"""DuckDB SQL for the operators' queries, where SQL can say them."""

from __future__ import annotations

ORACLES = {
    "op2_chat_formatting": r"""
WITH extra AS (
    SELECT -7 AS conv_id, turn, role, '\### Assistant: </turn> ok' AS text
    FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)
), turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT conv_id, turn, role, text FROM extra
), said AS (
    SELECT *, replace(replace(replace(text, '\', '\\'), '### ', '\### '), '</turn>', '\</turn>') AS shown,
        replace(replace(replace(replace(replace(role, '\', '\\'), '### ', '\### '), '</turn>', '\</turn>'), ':', '\:'), chr(10), '\' || chr(10)) AS shown_role
    FROM turns
), joined AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS everything,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS learned,
        sum(length('### ' || shown_role || ':' || chr(10) || shown || '</turn>' || chr(10)))::BIGINT AS formatted_chars
    FROM said GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(everything) AS turns_sha256, length(learned) AS loss_chars,
    sha256(learned) AS loss_sha256, formatted_chars
FROM joined
""",
}

ORACLES["op8_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), u AS (
    SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS e FROM v
), links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.vec_id <> y.vec_id AND list_dot_product(x.e, y.e) >= 0.9
), reach(node, other) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other
), degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT r.node AS vec_id, coalesce(max(d.n), 0)::BIGINT AS n_links, min(r.other) AS component_id,
    r.node = min(r.other) AS kept
FROM reach r LEFT JOIN degree d ON d.a = r.node GROUP BY r.node
"""

ORACLES["op4_substring_dedup"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), starts AS (
    SELECT doc_id, p, md5(array_to_string(ws[p:p + 34], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS p FROM d WHERE len(ws) >= 35)
), repeated AS (
    SELECT doc_id, p FROM starts WHERE h IN (SELECT h FROM starts GROUP BY h HAVING count(*) > 1)
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS i FROM repeated
), words AS (
    SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS w FROM d
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY 1
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
