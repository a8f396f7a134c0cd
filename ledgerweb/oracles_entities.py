"""Entity resolution, vectors and retrieval in DuckDB SQL; ``oracles`` puts the graph before each.

The published lists and patterns are the same fixed values; what is done with them is said here anew.
"""

from __future__ import annotations

from .functions import fixed_values as V
from .queries_entities import FORMS, NAMES, SAID


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(map(_text, values)) + "]"


def _in(what: str, values: list[str]) -> str:
    return f"{what} IN ({', '.join(map(_text, values))})"


def _any(what: str, patterns: list[str]) -> str:
    return "(" + " OR ".join(f"regexp_matches({what}, {_text(p)}, 'i')" for p in patterns) + ")"


def _strongest(signs: list[tuple[str, float]]) -> str:
    return "greatest(" + ", ".join(f"CASE WHEN regexp_matches(sentence, {_text(p)}, 'i') THEN {c} ELSE 0 END" for p, c in signs) + ")::DOUBLE"


_LOOKED_UP = "trim(regexp_replace(list_reduce(list_prepend(lower(trim({0})), " + _list(V.NAME_SUFFIXES) + "), lambda a, s: CASE WHEN ends_with(a, s) THEN left(a, length(a) - length(s)) ELSE a END), '^[\\s,.\\-]+|[\\s,.\\-]+$', '', 'g'))"

_CLAIMS = f""", mentioned AS (
    SELECT e.rel_type, src, dst, mentions, embedding_similarity, name,
        replace(replace(replace(({_list(FORMS)})[(src + dst) % {len(FORMS)} + 1], '{{n}}', name), '{{k}}', dst::VARCHAR), '{{l}}', lower(name)) AS mention
    FROM all_edges e JOIN company ON cik = dst
), claims AS (SELECT *, replace(({_list(SAID)})[(src * 7 + dst * 3 + mentions) % {len(SAID)} + 1], '{{m}}', mention) AS sentence FROM mentioned)
"""

_PATTERNS = [("biographical", V.BIOGRAPHICAL_PATTERNS), ("exchange", V.EXCHANGE_PATTERNS), ("corporate", V.CORPORATE_PATTERNS), ("platform", V.PLATFORM_PATTERNS)]


def _reason(negation: bool) -> str:
    words = f"""CASE WHEN {_in('upper(mention)', V.TICKER_BLOCKLIST)} THEN 'ticker_blocklist'
    WHEN {_in('lower(trim(mention))', V.NAME_BLOCKLIST)} AND NOT {_in('lower(trim(mention))', V.HIGH_VALUE_NAMES)} THEN 'name_blocklist'
    WHEN length(trim(mention)) < 2 THEN 'too_short'"""
    more = ([("negation", V.NEGATION_PATTERNS)] if negation else []) + _PATTERNS
    return words + "".join(f"\n    WHEN {_any('sentence', p)} THEN '{name}'" for name, p in more) + " END"


_SIGNS = [("HAS_COMPETITOR", V.COMPETITOR_SIGNS), ("HAS_SUPPLIER", V.SUPPLIER_SIGNS), ("HAS_CUSTOMER", V.CUSTOMER_SIGNS), ("HAS_PARTNER", V.PARTNER_SIGNS)]
_QUOTED = "regexp_replace(mention, '([^a-zA-Z0-9 ])', '\\\\\\1', 'g')"

_VERDICTS = _CLAIMS + ", scored AS (SELECT *, " + ", ".join(f"{_strongest(s)} AS c{i}" for i, (_, s) in enumerate(_SIGNS)) + f""" FROM claims), best AS (
    SELECT *, greatest(c0, c1, c2, c3) AS c, CASE greatest(c0, c1, c2, c3) WHEN c0 THEN 'HAS_COMPETITOR' WHEN c1 THEN 'HAS_SUPPLIER' WHEN c2 THEN 'HAS_CUSTOMER' ELSE 'HAS_PARTNER' END AS told,
        {_any('sentence', [p for p, _ in V.NO_RELATION_SIGNS])} AS none, regexp_matches(sentence, '["'']?' || {_QUOTED} || '\\s+of\\s+\\w+', 'i') AS figure
    FROM scored
)
SELECT rel_type, src, dst, CASE WHEN none OR figure THEN 'contradicted' WHEN c = 0 THEN 'uncertain' WHEN told = rel_type THEN 'confirmed' ELSE 'contradicted' END AS result,
    CASE WHEN none OR figure OR c = 0 OR told = rel_type THEN '' ELSE told END AS suggested, CASE WHEN none THEN 0.9 WHEN figure THEN 0.95 WHEN c = 0 THEN 0.3 ELSE c END::DOUBLE AS confidence FROM best"""

_TIER = """CASE WHEN embedding_similarity >= CASE rel_type WHEN 'HAS_COMPETITOR' THEN 0.35 WHEN 'HAS_PARTNER' THEN 0.5 ELSE 0.55 END THEN 'accept'
    WHEN embedding_similarity >= CASE rel_type WHEN 'HAS_COMPETITOR' THEN 0.25 ELSE 0.3 END THEN 'candidate' ELSE 'reject' END"""

_DECIDED = _CLAIMS + f""", alike AS (SELECT src, dst, max(embedding_similarity) AS embedding_similarity FROM claims WHERE (src + dst) % 4 <> 0 GROUP BY 1, 2), decided AS (
    SELECT c.rel_type, c.src, c.dst, a.embedding_similarity,
        length(trim(mention)) <= 2 AND NOT {_in('lower(trim(mention))', V.SHORT_MENTIONS)}
            AND NOT regexp_matches(lower(sentence), lower(mention) || ',|' || lower(mention) || '\\s+and|(?:such\\s+as|including)\\s+' || lower(mention)) AS short,
        {_any('sentence', [*V.BIOGRAPHICAL_PATTERNS, *V.EXCHANGE_PATTERNS, *V.CORPORATE_PATTERNS])} AS told,
        CASE WHEN c.src % 2 = 0 AND c.rel_type IN ('HAS_SUPPLIER', 'HAS_CUSTOMER') THEN c.dst % 3 END AS verdict
    FROM claims c LEFT JOIN alike a USING (src, dst)
), decisions AS (
    SELECT rel_type, src, dst, CASE WHEN short OR told THEN 'reject' WHEN embedding_similarity IS NOT NULL THEN {_TIER} WHEN verdict = 0 THEN 'accept' WHEN verdict = 1 THEN 'candidate' ELSE 'reject' END AS decision,
        CASE WHEN short THEN 1 WHEN told THEN 2 WHEN embedding_similarity IS NULL AND verdict < 2 THEN 4 ELSE 3 END::BIGINT AS decided_by FROM decided
)
"""

_SPELLINGS = f""", keys AS (
    SELECT kind, key, arg_max(cik, cik) AS cik, arg_max(name, cik) AS name FROM (
        SELECT 0 AS kind, upper(ticker) AS key, cik, name FROM company UNION ALL SELECT 1, lower(name), cik, name FROM company UNION ALL SELECT 1, {_LOOKED_UP.format('name')}, cik, name FROM company
    ) GROUP BY 1, 2
)
"""

_HIGH = "(" + " OR ".join(f"contains(lower(name), {_text(h)})" for h in V.HIGH_VALUE_NAMES) + ")"
_SETS = "list_distinct(string_split(trim(lower({0})), ' '))"

_RESOLVED = _CLAIMS + f""", passed AS (SELECT * EXCLUDE name FROM claims WHERE NOT {_in('upper(mention)', V.TICKER_BLOCKLIST)} AND (NOT {_in('lower(trim(mention))', V.NAME_BLOCKLIST)} OR {_in('lower(trim(mention))', V.HIGH_VALUE_NAMES)}) AND length(trim(mention)) >= 2
), ways AS (
    SELECT p.*, 'exact_ticker' AS match_type, 0 AS way, cik, name FROM passed p JOIN company ON mention = upper(mention) AND upper(ticker) = trim(mention)
    UNION ALL SELECT p.*, 'exact_name', 1, cik, name FROM passed p JOIN company ON lower(name) = lower(trim(mention))
    UNION ALL SELECT p.*, 'normalized_name', 2, cik, name FROM passed p JOIN company ON {_LOOKED_UP.format('name')} = {_LOOKED_UP.format('mention')}
), met AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rel_type, src, dst ORDER BY way, cik DESC) AS r FROM ways) WHERE r = 1 AND cik <> src
), rated AS (
    SELECT *, 0.4 * CASE way WHEN 2 THEN 0.95 ELSE 1.0 END + 0.2 * CASE WHEN length(trim(mention)) <= 2 THEN 0.3 WHEN length(trim(mention)) <= 4 THEN 0.6 WHEN length(trim(mention)) <= 6 THEN 0.8 ELSE 1.0 END
        + 0.2 * ([0.6, 0.8, 0.9, 1.0])[1 + least(3, {' + '.join(f"contains(lower(sentence), {_text(w)})::INTEGER" for w in V.CONTEXT_WORDS)})] + 0.1 * CASE WHEN {_HIGH} THEN 1.0 ELSE 0.5 END
        + 0.1 * CASE WHEN lower(mention) = lower(name) THEN 1.0 WHEN contains(lower(name), lower(mention)) OR contains(lower(mention), lower(name)) THEN 0.9
            ELSE 0.5 + 0.5 * len(list_intersect({_SETS.format('mention')}, {_SETS.format('name')})) / len(list_distinct(list_concat({_SETS.format('mention')}, {_SETS.format('name')}))) END AS confidence FROM met
)
SELECT rel_type, src, dst, cik, match_type, round(least(1.0, confidence), 6)::DOUBLE AS confidence FROM rated WHERE confidence >= 0.5"""

_NAMES = f""", names AS (
    SELECT c_custkey AS id, replace(replace(replace(({_list(NAMES)})[c_custkey % {len(NAMES)} + 1], '{{n}}', c_name), '{{s}}', upper(c_mktsegment[1]) || lower(c_mktsegment[2:])), '{{k}}', c_custkey::VARCHAR) AS name FROM customer
), spoken AS (SELECT *, CASE id % 3 WHEN 0 THEN upper(name) WHEN 1 THEN left(name, 9) ELSE name || ' Corp' END AS mention FROM names)
"""

_WORDS = "list_filter(regexp_split_to_array(trim(regexp_replace(strip_accents(lower({0})), '[^\\w\\s]+|_', ' ', 'g')), '\\s+'), lambda w: w <> '' AND NOT list_contains({1}, w))"
_FOLDED = "array_to_string(" + _WORDS.format("{0}", _list([*V.NOISE_WORDS, *V.CORPORATE_SUFFIXES])) + ", ' ')"


def _grams(folded: str) -> str:
    compact = f"('*' || replace({folded}, ' ', '') || '*')"
    each = ", ".join(f"list_transform(range(1, length({compact}) - {n} + 2), lambda i: substr({compact}, i, {n}))" for n in (2, 3, 4, 5))
    return f"CASE WHEN {folded} = '' THEN []::VARCHAR[] ELSE list_distinct(flatten([{each}, list_transform(list_filter(string_split({folded}, ' '), lambda w: length(w) >= 2), lambda w: '*' || w || '*')])) END"


_FOLDED_NAMES = _NAMES + f", folded AS (SELECT *, {_FOLDED.format('name')} AS fn, {_FOLDED.format('mention')} AS fm FROM spoken), grams AS (SELECT *, {_grams('fn')} AS gn, {_grams('fm')} AS gm FROM folded)\n"

_CHARACTERS = _FOLDED_NAMES + """, rated AS (SELECT *, CASE WHEN len(gn) = 0 OR len(gm) = 0 THEN 0.0 ELSE round(len(list_intersect(gn, gm)) / len(list_distinct(list_concat(gn, gm))), 9) END::DOUBLE AS score FROM grams)
SELECT id, score, CASE WHEN score >= 0.5 THEN 'strong' WHEN score >= 0.3 THEN 'moderate' WHEN score >= 0.15 THEN 'weak' ELSE 'poor' END || '_character_match' AS label, fn = fm AS same, length(fm) >= 4 AND starts_with(fn, fm) AS begins, upper(trim(mention)) = upper(trim(name)) AS ticker FROM rated"""

_RANKED = _FOLDED_NAMES + """, few AS (SELECT DISTINCT mention, gm FROM grams WHERE id % 10 = 3 AND mention <> '...'), firms AS (SELECT id AS cik, gn FROM grams WHERE id % 7 = 1), met AS (
    SELECT mention, cik, len(list_intersect(gn, gm)) / len(list_distinct(list_concat(gn, gm))) AS score FROM few, firms WHERE len(list_intersect(gn, gm)) > 0
)
SELECT mention, cik, round(score, 9) AS score FROM (SELECT *, row_number() OVER (PARTITION BY mention ORDER BY round(score, 9) DESC, cik) AS r FROM met) WHERE r <= 3"""

_PARTIAL = _NAMES + f""", pk AS (
    SELECT key, max(id) AS cik FROM (SELECT lower(trim(name)) AS key, id FROM names UNION ALL SELECT {_LOOKED_UP.format('name')}, id FROM names) WHERE length(key) >= 3 GROUP BY 1
), asked AS (
    SELECT DISTINCT query FROM (SELECT unnest([lower(name), left(lower(name), length(name) - 1), string_split(lower(name), ' ')[1], lower(name) || ' of america']) AS query FROM names) WHERE length(query) >= 3
), met AS (
    SELECT query, key, cik, CASE WHEN query = key THEN 1.0 WHEN starts_with(key, query || ' ') THEN 0.95 WHEN length(query) / length(key) > 0.6 THEN 0.85 * length(query) / length(key) ELSE 0 END AS confidence FROM asked JOIN pk ON starts_with(key, query)
)
SELECT query, cik, round(confidence, 9)::DOUBLE AS confidence FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY confidence DESC, key, cik) AS r FROM met WHERE confidence > 0.8) WHERE r = 1"""

_STRIP = "regexp_replace(regexp_replace({0}, '^\\s+', ''), '\\s+$', '')"

_COSINES = ", v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), s AS (SELECT v.vec_id, vec_id % n AS cik, round(list_cosine_similarity(v.e, q.e), 6) AS score FROM v, n_company, (SELECT e FROM v WHERE vec_id = 3) q)\n"

_RELATED = """, u AS (SELECT DISTINCT src, dst, rel_type FROM (SELECT src, dst, rel_type FROM all_edges UNION ALL SELECT dst, src, rel_type FROM all_edges)), pairs AS (SELECT DISTINCT src, dst FROM u),
one AS (SELECT src AS source, dst AS node, rel_type AS relation FROM u JOIN started ON src = start),
two AS (SELECT DISTINCT source, dst AS node, relation, node AS via FROM one JOIN pairs ON src = node WHERE dst <> source),
every AS (SELECT source, node, relation, NULL::BIGINT AS via, 1::BIGINT AS hops FROM one UNION ALL SELECT source, node, relation, via, 2 FROM two),
related AS (
    SELECT * FROM every WHERE node <> source
    ORDER BY hops, CASE relation WHEN 'HAS_SUPPLIER' THEN 1 WHEN 'HAS_CUSTOMER' THEN 2 WHEN 'HAS_PARTNER' THEN 3 WHEN 'HAS_COMPETITOR' THEN 4 ELSE 7 END, source, node, relation, via NULLS FIRST LIMIT 100
)
"""


def _near(where: str, least: float, top: int) -> str:
    return f""", nv AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda y: y * y)))) AS e FROM embeddings WHERE {where}),
np AS (SELECT x.vec_id AS a, y.vec_id AS b, round(list_dot_product(x.e, y.e), 9) AS score FROM nv x JOIN nv y ON x.vec_id <> y.vec_id)
SELECT least(a, b) AS key1, greatest(a, b) AS key2, round(max(score), 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS r FROM np WHERE score >= {least}) WHERE r <= {top} GROUP BY 1, 2"""


_PARTS = ["acme", "blue", "corp", "delta", "east", "first", "global", "inc"]

ENTITIES = {
    "ent06_sentences_around": f""", t AS (SELECT doc_id, text, doc_id * 37 % greatest(length(text), 1) AS place FROM documents WHERE text IS NOT NULL), h AS (SELECT doc_id, left(text, place) AS head, substr(text, place + 1) AS tail FROM t)
SELECT doc_id, md5(left({_STRIP.format("CASE WHEN regexp_matches(head, '[.!?]\\s+') THEN regexp_extract(head, '(?s)^.*[.!?]\\s+(.*)$', 1) ELSE head END || regexp_extract(tail, '(?s)^(.*?[.!?]\\s+|.*$)', 1)")}, 500)) AS sentence FROM h""",
    "ent16_self_references": _CLAIMS + "SELECT c.rel_type, src, dst, CASE WHEN src % 2 = 0 THEN true ELSE contains(lower(mention), lower(o.name)) OR upper(mention) = 'T' || dst END AS itself FROM claims c JOIN company o ON o.cik = src",
    "ent17_filter_reasons": _CLAIMS + f"SELECT rel_type, src, dst, coalesce({_reason(True)}, '') AS reason FROM claims",
    "ent18_filter_counts": _CLAIMS + f"SELECT coalesce({_reason(False)}, 'passed') AS reason, count(*) AS n FROM claims GROUP BY 1",
    "ent20_folded_names": _NAMES + f"SELECT id, {_FOLDED.format('name')} AS folded, array_to_string({_WORDS.format('name', _list(V.NOISE_WORDS))}, ' ') AS whole, {_LOOKED_UP.format('name')} AS looked_up FROM names",
    "ent22_ngram_sets": _FOLDED_NAMES + "SELECT id, array_to_string(list_sort(gn), ' ') AS grams FROM grams",
    "ent23_ranked_names": _RANKED,
    "ent24_character_scores": _CHARACTERS,
    "ent29_resolved_mentions": _RESOLVED,
    "ent30_mention_texts": _CLAIMS + """, c AS (SELECT *, left(sentence, 60) AS cut, CASE WHEN contains(left(sentence, 60), '.') THEN 61 - strpos(reverse(left(sentence, 60)), '.') - (60 - length(left(sentence, 60))) ELSE 0 END AS stop FROM claims)
SELECT rel_type, src, dst, mention || CASE WHEN src % 2 = 0 THEN ' (' || rel_type || ')' ELSE '' END || ' : ' || CASE WHEN length(sentence) > 60 AND stop > 30 THEN left(cut, stop) ELSE cut END AS shown FROM c""",
    "ent31_semantic_scores": """, scored AS MATERIALIZED (
    SELECT m.vec_id AS mention, round(list_cosine_similarity(m.embedding::DOUBLE[], k.embedding::DOUBLE[]), 6) AS score FROM embeddings m JOIN embeddings k ON k.vec_id = m.vec_id % 130 WHERE k.vec_id < 120 AND m.vec_id % 17 <> 0 AND k.vec_id % 13 <> 0
), r AS (
    SELECT vec_id AS mention, vec_id % 130 AS cik, coalesce(score, 0)::DOUBLE AS score, CASE WHEN vec_id % 130 >= 120 OR vec_id % 130 % 13 = 0 THEN 'no_candidate_embedding' WHEN vec_id % 17 = 0 THEN 'embedding_error' ELSE 'cosine_embedding' END AS method
    FROM embeddings LEFT JOIN scored ON mention = vec_id
)
SELECT *, CASE WHEN score >= 0.75 THEN 'strong' WHEN score >= 0.6 THEN 'moderate' WHEN score >= 0.45 THEN 'weak' ELSE 'poor' END || '_semantic_match' AS label FROM r""",
    "ent32_combined": """, x AS (SELECT rel_type, src, dst, 0.4 * (src % 11) / 10 + 0.6 * embedding_similarity AS base, CASE WHEN dst % 7 = 0 THEN 0.3 ELSE 0 END + CASE WHEN dst % 5 = 0 THEN 0.2 ELSE 0 END AS bonus FROM all_edges), y AS (SELECT *, least(1.0, base + bonus * (1 - base)) AS score FROM x)
SELECT rel_type, src, dst, round(score, 9)::DOUBLE AS score, CASE WHEN score >= 0.75 OR dst % 7 = 0 THEN 'high' WHEN score >= 0.5 THEN 'medium' ELSE 'low' END AS tier FROM y""",
    "ent33_context_similarities": ", r AS (SELECT c.vec_id, CASE WHEN k.vec_id IS NULL THEN 1.0 ELSE round(list_cosine_similarity(c.embedding::DOUBLE[], k.embedding::DOUBLE[]), 6) END::DOUBLE AS similarity FROM embeddings c LEFT JOIN embeddings k ON k.vec_id = c.vec_id % 150 AND k.vec_id < 120) SELECT *, similarity >= 0.3 AS passed FROM r",
    "ent34_verdicts": _VERDICTS,
    "ent35_tiered_decisions": _DECIDED + "SELECT * FROM decisions",
    "ent36_decision_costs": _DECIDED + "SELECT " + ", ".join(f"count(*) FILTER (decided_by = {i}) AS tier{i}" for i in (1, 2, 3, 4)) + ", round(sum(CASE decided_by WHEN 3 THEN 0.001 WHEN 4 THEN 0.01 ELSE 0 END), 9)::DOUBLE AS cost, round(avg(CASE decided_by WHEN 3 THEN 0.001 WHEN 4 THEN 0.01 ELSE 0 END), 9)::DOUBLE AS per_decision FROM decisions",
    "ent38_candidate_companies": _CLAIMS + _SPELLINGS + f""", asked AS (SELECT rel_type, src, dst, mention, {_in('lower(trim(mention))', V.HIGH_VALUE_NAMES)} AS known FROM claims WHERE NOT {_in('upper(trim(mention))', V.TICKER_BLOCKLIST)} AND (NOT {_in('lower(trim(mention))', V.NAME_BLOCKLIST)} OR {_in('lower(trim(mention))', V.HIGH_VALUE_NAMES)})),
ways AS (
    SELECT a.*, 0 AS way, k.* FROM asked a JOIN keys k ON kind = 0 AND key = upper(trim(mention)) UNION ALL SELECT a.*, 1, k.* FROM asked a JOIN keys k ON kind = 1 AND key = lower(trim(mention))
    UNION ALL SELECT a.*, 2, k.* FROM asked a JOIN keys k ON kind = 1 AND key = {_LOOKED_UP.format('mention')}
), met AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rel_type, src, dst ORDER BY way) AS r FROM ways WHERE cik <> src) WHERE r = 1)
SELECT rel_type, src, dst, cik, CASE way WHEN 2 THEN 0.95 ELSE 1.0 END::DOUBLE AS confidence FROM met WHERE NOT (CASE way WHEN 2 THEN length(key) ELSE length(mention) END <= 4) OR known OR {_HIGH}""",
    "ent40_told_competitors": "SELECT src, dst, CASE WHEN dst % 3 = 0 THEN 0.9 ELSE 1.0 END::DOUBLE AS confidence FROM has_competitor",
    "ent43_verification_costs": _CLAIMS + "SELECT count(*) AS claims, sum(200 + length(sentence) // 4)::BIGINT AS tokens_in, count(*) * 100 AS tokens_out, round((sum(200 + length(sentence) // 4) * 0.15 + count(*) * 100 * 0.6) / 1e6, 9)::DOUBLE AS cost FROM claims",
    "joi20_partial_names": _PARTIAL,
    "joi21_fuzzy_names": ", p AS (SELECT p_partkey AS k, p_partkey // 2 % 300 AS m FROM part), w AS (SELECT k, " + " || ' ' || ".join(f"'{x}' || (m // {j + 1} % 7)" for j, x in enumerate(_PARTS)) + """ AS name FROM p), firms AS (SELECT name, max(k) AS cik FROM w WHERE k % 2 = 0 GROUP BY 1), asked AS (SELECT DISTINCT name || ' more' AS candidate FROM w WHERE k % 2 = 1), met AS (
    SELECT candidate, cik, len(list_intersect(string_split(candidate, ' '), string_split(name, ' '))) / len(list_distinct(list_concat(string_split(candidate, ' '), string_split(name, ' ')))) AS score FROM asked, firms
)
SELECT candidate, cik, 'fuzzy_name' AS match_type, round(score * 0.9, 9) AS confidence FROM (SELECT *, row_number() OVER (PARTITION BY candidate ORDER BY score DESC, cik) AS r FROM met WHERE score >= 0.85) WHERE r = 1""",
    "emb01_token_windows": """, t AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '') AS ws FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, ws, unnest(range(0, CASE WHEN len(ws) <= 300 THEN 1 ELSE ceil((len(ws) - 300) / 250.0)::BIGINT + 1 END)) AS part FROM t WHERE len(ws) > 0), s AS (SELECT doc_id, part, ws[part * 250 + 1:part * 250 + 300] AS w FROM p)
SELECT doc_id, part, len(w) AS n, md5(array_to_string(w, ' ')) AS digest FROM s""",
    "emb04_long_text_vectors": """, x AS (SELECT label, exp(-0.2 * (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1)) AS w, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 3 <> 0), y AS (SELECT label, w, unnest(range(0, len(e))) AS pos, unnest(e) AS v FROM x),
z AS (SELECT label, pos, round(sum(v * w) / sum(w), 6) AS v FROM y GROUP BY 1, 2) SELECT l.label, pos, v FROM (SELECT DISTINCT label FROM embeddings) l LEFT JOIN z ON l.label IS NOT DISTINCT FROM z.label""",
    "emb06_truncated": "SELECT doc_id, md5(CASE WHEN length(text) // 4 <= 100 THEN text ELSE left(text, 350) END) AS digest FROM documents",
    "emb07_token_batches": """, n AS (SELECT source, doc_id, coalesce(length(text) // 4, 0) AS tokens, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS place FROM documents), walk(source, place, batch, held) AS (
    SELECT source, 1::BIGINT, 0::BIGINT, tokens FROM n WHERE place = 1
    UNION ALL
    SELECT n.source, n.place, CASE WHEN held + tokens > 40000 THEN batch + 1 ELSE batch END, CASE WHEN held + tokens > 40000 THEN tokens ELSE held + tokens END FROM walk JOIN n ON n.source IS NOT DISTINCT FROM walk.source AND n.place = walk.place + 1
)
SELECT n.source, doc_id, batch FROM walk JOIN n ON n.source IS NOT DISTINCT FROM walk.source AND n.place = walk.place""",
    "sim01_valid_vectors": "SELECT vec_id, vec_id % 5 IN (2, 4) AS valid, vec_id % 3 <> 0 AND vec_id / 100 - 1 BETWEEN -1 AND 1 AS score FROM embeddings",
    "sim08_domain_pairs": _near("vec_id > 0", 0.3, 3),
    "sim09_keyword_pairs": _near("vec_id IN (SELECT doc_id FROM documents WHERE length(text) >= 1500)", 0.3, 3),
    "rag05_search_around": _COSINES + """, e AS (SELECT src, dst FROM has_competitor UNION ALL SELECT src, dst FROM has_partner UNION ALL SELECT key1, key2 FROM description_pairs), near AS (SELECT 7 AS cik UNION SELECT dst FROM e WHERE src = 7 UNION SELECT src FROM e WHERE dst = 7)
SELECT vec_id, score FROM s WHERE cik IN (SELECT cik FROM near) AND score >= 0 ORDER BY score DESC, vec_id LIMIT 10""",
    "joi16_related_companies": ", started AS (SELECT unnest([7, 9]) AS start)" + _RELATED + "SELECT source, node, relation, via, hops FROM related",
    "rag06_answer_context": _COSINES + ", first AS (SELECT * FROM s WHERE score >= 0.5 ORDER BY score DESC, vec_id LIMIT 24), started AS (SELECT DISTINCT cik AS start FROM first JOIN company USING (cik))" + _RELATED + """, told AS (SELECT node AS cik, hops, source AS related_to FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY hops, source, relation, via NULLS FIRST) AS r FROM related) WHERE r = 1),
more AS (SELECT * FROM s WHERE cik IN (SELECT cik FROM told) AND score >= 0.15 ORDER BY score DESC, vec_id LIMIT 24),
both_ AS (SELECT *, 'vector_search' AS origin FROM first UNION ALL SELECT *, 'graph_traversal' FROM more WHERE vec_id NOT IN (SELECT vec_id FROM first)), best AS (SELECT * FROM both_ ORDER BY score DESC, vec_id LIMIT 12)
SELECT vec_id AS chunk_id, score, origin, CASE WHEN origin = 'graph_traversal' THEN hops END AS hops, CASE WHEN origin = 'graph_traversal' THEN related_to END AS related_to, md5('[' || vec_id || '] ' || text) AS line
FROM best LEFT JOIN told USING (cik) JOIN documents ON doc_id = vec_id""",
}
