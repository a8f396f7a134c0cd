"""The same results in DuckDB SQL, over the same tables."""

from __future__ import annotations

from .graph import RELATIONS

_LISTED = "array_to_string(list_sort(list(DISTINCT {0})), ',')"
_SOME = "array_to_string(list_sort(list(DISTINCT {0}))[1:{1}], ',')"


def _relation(name: str, flag: str, quantity: int) -> str:
    return f"""{name.lower()} AS (
    SELECT a.l_suppkey AS src, b.l_suppkey AS dst, max(round(1 - a.l_discount * 5, 6)) AS confidence,
        max(round(b.l_quantity / 50, 6)) AS embedding_similarity, count(*) AS mentions
    FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber AND a.l_suppkey <> b.l_suppkey
    WHERE a.l_quantity = {quantity} AND a.l_returnflag = '{flag}' AND b.l_quantity < {quantity} GROUP BY 1, 2
)"""


#: The graph, as the adapters build it.
GRAPH = "WITH RECURSIVE " + ",\n".join([
    """company AS (
    SELECT s_suppkey AS cik, s_name AS name, 'T' || s_suppkey AS ticker, n_name AS industry, r_name AS sector,
        n_nationkey::BIGINT AS sic, CASE WHEN s_acctbal >= 0 THEN s_acctbal * 1e6 END AS revenue,
        CASE WHEN s_acctbal >= 0 THEN s_acctbal * 1e6 END * 2 AS market_cap, s_suppkey * 37 % 20000 AS employees
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)""",
    *(_relation(r, *v) for r, v in RELATIONS.items()),
    "all_edges AS (" + " UNION ALL ".join(f"SELECT *, '{r}' AS rel_type FROM {r.lower()}" for r in RELATIONS) + ")",
    "technology AS (SELECT DISTINCT p_brand || '/' || p_type AS technology, p_type AS category FROM part)",
    """uses AS (
    SELECT DISTINCT o_custkey AS domain, p_brand || '/' || p_type AS technology
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE l_quantity >= 45
)""",
    "has_domain AS (SELECT s_suppkey AS src, c_custkey AS dst FROM customer JOIN supplier ON c_custkey % (SELECT count(*) FROM supplier) = s_suppkey)",
    "company_uses AS (SELECT DISTINCT src AS cik, technology FROM has_domain JOIN uses ON dst = domain)",
    "n_company AS (SELECT count(*) AS n FROM supplier)",
    *(
        f"""{name}_vec AS (
    SELECT vec_id - {shift} * n AS cik, list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda y: y * y)))) AS e
    FROM embeddings, n_company WHERE vec_id - {shift} * n IN (SELECT s_suppkey FROM supplier) AND vec_id IN (SELECT doc_id FROM documents WHERE length(text) >= 200)
), {name}_near AS (
    SELECT x.cik AS a, y.cik AS b, round(list_dot_product(x.e, y.e), 9) AS score FROM {name}_vec x JOIN {name}_vec y ON x.cik <> y.cik
), {name}_pairs AS (
    SELECT least(a, b) AS key1, greatest(a, b) AS key2, max(score) AS score
    FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS r FROM {name}_near) WHERE r <= 50 AND score >= 0.25 GROUP BY 1, 2
)"""
        for name, shift in (("description", 0), ("risk", 1), ("keyword", 2))
    ),
    """tech_size AS (SELECT cik, count(*) AS n FROM company_uses GROUP BY 1), tech_jaccard AS (
    SELECT a, b, shared, shared / (x.n + y.n - shared) AS score FROM (
        SELECT x.cik AS a, y.cik AS b, count(*) AS shared FROM company_uses x JOIN company_uses y USING (technology) WHERE x.cik < y.cik GROUP BY 1, 2
    ) p JOIN tech_size x ON x.cik = a JOIN tech_size y ON y.cik = b
)""",
    """class_pairs AS (
    SELECT a, b, min_by(method, rank) AS method FROM (
        SELECT x.cik AS a, y.cik AS b, 'sic' AS method, 0 AS rank FROM company x JOIN company y ON x.sic = y.sic AND x.cik < y.cik
        UNION ALL SELECT x.cik, y.cik, 'sector', 1 FROM company x JOIN company y ON x.sector = y.sector AND x.cik < y.cik
    ) GROUP BY 1, 2
)""",
    """sized AS (
    SELECT cik, 0 AS rank, 'revenue' AS method, CASE WHEN revenue < 1e8 THEN 0 WHEN revenue < 1e9 THEN 1 WHEN revenue < 1e10 THEN 2 ELSE 3 END AS bucket FROM company WHERE revenue IS NOT NULL
    UNION ALL SELECT cik, 1, 'market_cap', CASE WHEN market_cap < 1e8 THEN 0 WHEN market_cap < 1e9 THEN 1 WHEN market_cap < 1e10 THEN 2 ELSE 3 END FROM company WHERE market_cap IS NOT NULL
    UNION ALL SELECT cik, 2, 'employees', CASE WHEN employees < 100 THEN 0 WHEN employees < 1000 THEN 1 WHEN employees < 10000 THEN 2 ELSE 3 END FROM company WHERE employees IS NOT NULL
), size_pairs AS (
    SELECT a, b, min_by(method, rank) AS method, min_by(bucket, rank) AS bucket FROM (
        SELECT x.cik AS a, y.cik AS b, x.rank, x.method, x.bucket FROM sized x JOIN sized y ON x.method = y.method AND x.bucket = y.bucket AND x.cik < y.cik
    ) GROUP BY 1, 2
)""",
    """similar_edges AS (
    SELECT key1 AS src, key2 AS dst, 'SIMILAR_DESCRIPTION' AS rel_type, round(score, 6) AS score FROM description_pairs
    UNION ALL SELECT key1, key2, 'SIMILAR_RISK', round(score, 6) FROM risk_pairs
    UNION ALL SELECT a, b, 'SIMILAR_INDUSTRY', 1.0 FROM class_pairs WHERE method = 'sic'
    UNION ALL SELECT a, b, 'SIMILAR_SIZE', 1.0 FROM size_pairs
    UNION ALL SELECT a, b, 'SIMILAR_TECHNOLOGY', round(score, 6) FROM tech_jaccard WHERE score >= 0.2
)""",
    "wide AS (SELECT src, dst, " + ", ".join(f"max(score) FILTER (rel_type = 'SIMILAR_{k.upper()}') AS {k}" for k in ("description", "risk", "industry", "size", "technology")) + " FROM similar_edges GROUP BY 1, 2)",
]) + "\n"

_IN = "(SELECT dst AS cik, count(*) AS n FROM has_competitor GROUP BY 1)"
_OUT = "(SELECT src AS cik, count(*) AS n FROM has_competitor GROUP BY 1)"

CATALOGUE = {
    "qry01_market_leaders": f"SELECT cik, name, n AS cited_by FROM {_IN} JOIN company USING (cik) ORDER BY n DESC, cik LIMIT 10",
    "qry02_threat_ratio": f"SELECT i.cik, i.n AS cited_by, o.n AS cites, round(i.n / o.n * 10) / 10 AS ratio FROM {_IN} i JOIN {_OUT} o USING (cik) WHERE i.n >= 5 ORDER BY ratio DESC, cited_by DESC, cik LIMIT 20",
    "qry03_mutual_rivals": "SELECT x.src AS a, x.dst AS b FROM has_competitor x JOIN has_competitor y ON x.src = y.dst AND x.dst = y.src WHERE x.src < x.dst",
    "qry04_aspiring_disruptors": "SELECT x.src, left(name, 12) AS challenger, x.dst, x.confidence FROM has_competitor x JOIN company ON cik = x.src WHERE x.dst IN (1, 2, 3, 5, 8) AND NOT EXISTS (SELECT 1 FROM has_competitor y WHERE y.src = x.dst AND y.dst = x.src)",
    "qry05_shared_competitors": f"SELECT x.src AS a, y.src AS b, count(*) AS shared, {_SOME.format('x.dst', 5)} AS sample FROM has_competitor x JOIN has_competitor y ON x.dst = y.dst AND x.src < y.src GROUP BY 1, 2 HAVING count(*) >= 2",
    "qry06_competitors_with_evidence": "SELECT dst, name, confidence, mentions FROM has_competitor JOIN company ON cik = dst WHERE src = 7",
    "qry07_competitors_of_competitors": f"SELECT x.dst AS competitor, count(DISTINCT y.dst) AS n, coalesce(array_to_string(list_sort(list(DISTINCT y.dst) FILTER (y.dst IS NOT NULL)), ','), '') AS their_competitors FROM has_competitor x LEFT JOIN has_competitor y ON x.dst = y.src WHERE x.src = 7 GROUP BY 1",
    "qry08_similar_descriptions": "SELECT key1, key2, round(score, 6) AS score FROM description_pairs",
    "qry09_explainable_similarity": "SELECT * FROM wide WHERE description IS NOT NULL ORDER BY description DESC, src, dst LIMIT 25",
    "qry10_multi_dimensional_similarity": "SELECT src, dst, round(0.4 * description + 0.3 * coalesce(industry, 0) + 0.3 * coalesce(size, 0), 6) AS score FROM wide WHERE description > 0 AND round(0.4 * description + 0.3 * coalesce(industry, 0) + 0.3 * coalesce(size, 0), 6) > 0.3",
    "qry11_key_suppliers": f"SELECT dst AS supplier, count(DISTINCT src) AS customers, {_SOME.format('src', 5)} AS sample FROM has_supplier GROUP BY 1 ORDER BY customers DESC, supplier LIMIT 10",
    "qry12_verified_suppliers": "SELECT src, dst, confidence FROM has_supplier WHERE confidence >= 0.9",
    "qry13_verified_customers": "SELECT src, dst, confidence FROM has_customer WHERE confidence >= 0.9",
    "qry14_technologies_of_company": "SELECT technology, category FROM company_uses JOIN technology USING (technology) WHERE cik = 7",
    "qry16_cited_sample": f"SELECT src, count(*) AS cites, {_SOME.format('dst', 8)} AS sample FROM has_competitor GROUP BY 1",
    "qry17_landscape": f"SELECT cik, coalesce(competitors, '') AS competitors, coalesce(n_tech, 0) AS n_tech FROM company LEFT JOIN (SELECT src AS cik, {_LISTED.format('dst')} AS competitors FROM has_competitor GROUP BY 1) USING (cik) LEFT JOIN (SELECT cik, count(*) AS n_tech FROM company_uses GROUP BY 1) USING (cik)",
    "qry18_supply_chain": f"SELECT cik, coalesce(suppliers, '') AS suppliers, coalesce(customers, '') AS customers FROM company LEFT JOIN (SELECT src AS cik, {_LISTED.format('dst')} AS suppliers FROM has_supplier GROUP BY 1) USING (cik) LEFT JOIN (SELECT src AS cik, {_LISTED.format('dst')} AS customers FROM has_customer GROUP BY 1) USING (cik)",
    "qry19_next_technologies": "SELECT technology, count(*) AS peers FROM company_uses WHERE cik IN (SELECT x.cik FROM company_uses x JOIN company_uses y USING (technology) WHERE y.cik = 7 AND x.cik <> 7 GROUP BY 1 HAVING count(*) >= 2) AND technology NOT IN (SELECT technology FROM company_uses WHERE cik = 7) GROUP BY 1 ORDER BY peers DESC, technology LIMIT 10",
    "qry20_industry_leaders": "SELECT industry, dst, count(*) AS cited_by FROM has_competitor JOIN company ON cik = dst WHERE sector = 'EUROPE' GROUP BY 1, 2",
    "qry22_adopters_per_technology": "SELECT technology, count(DISTINCT domain) AS adopters FROM uses GROUP BY 1 HAVING count(DISTINCT domain) >= 20",
    "qry23_suppliers_two_hops": "SELECT DISTINCT y.dst AS cik FROM has_supplier x JOIN has_supplier y ON x.dst = y.src WHERE x.src = 7",
    "qry24_exposure": ", walk(node, hops) AS (SELECT 7::BIGINT, 0 UNION SELECT dst, hops + 1 FROM walk JOIN has_supplier ON src = node WHERE hops < 2) SELECT node AS cik, min(hops)::BIGINT AS hops FROM walk WHERE node <> 7 GROUP BY 1",
    "qry25_dependants": f"SELECT src, count(*) AS suppliers, {_LISTED.format('dst')} AS which FROM has_supplier WHERE dst IN (1, 2, 3) GROUP BY 1",
    "qry26_companies_using": "SELECT cik, name, technology FROM company_uses JOIN company USING (cik) WHERE technology LIKE 'Brand#1/%'",
    "qry27_similar_suppliers": "SELECT p.cik, s.src, s.dst, name AS supplier FROM (SELECT key1 AS cik, key2 AS src FROM description_pairs UNION ALL SELECT key2, key1 FROM description_pairs) p JOIN has_supplier s USING (src) JOIN company c ON c.cik = s.dst WHERE name LIKE '%00003%'",
    "qry29_count_summary": "SELECT 'node' AS kind, 'Company' AS name, count(*) AS n FROM company UNION ALL SELECT 'node', 'Domain', count(*) FROM customer UNION ALL SELECT 'node', 'Technology', count(*) FROM technology UNION ALL SELECT 'edge', 'USES', count(*) FROM uses UNION ALL SELECT 'edge', 'HAS_DOMAIN', count(*) FROM has_domain UNION ALL SELECT 'edge', rel_type, count(*) FROM all_edges GROUP BY rel_type",
    "qry31_relation_evidence": "SELECT rel_type, src, dst, confidence, mentions FROM all_edges WHERE src = 7 OR dst = 7",
    "qry32_edge_presence": "SELECT src, dst, (SELECT count(*) FROM all_edges e WHERE e.src = v.src AND e.dst = v.dst) AS edges FROM (VALUES (1::BIGINT, 2::BIGINT), (2, 3), (7, 9)) v(src, dst)",
    "qry33_coverage": "SELECT count(*) AS companies, count(revenue) AS with_revenue, count(*) FILTER (cik IN (SELECT src FROM has_domain)) AS with_domain, count(*) FILTER (cik IN (SELECT src FROM has_competitor)) AS with_competitor FROM company",
    "sim17_similar_companies": """, t AS (SELECT cik AS dst, count(*) AS shared_tech FROM company_uses WHERE technology IN (SELECT technology FROM company_uses WHERE cik = 7) GROUP BY 1),
s AS (
    SELECT dst, sum(0.8 * score) AS score, count(*) FILTER (rel_type = 'SIMILAR_RISK') AS similar_risk_matches, count(*) FILTER (rel_type = 'SIMILAR_DESCRIPTION') AS similar_description_matches
    FROM (SELECT src, dst, rel_type, score FROM similar_edges UNION ALL SELECT dst, src, rel_type, score FROM similar_edges)
    WHERE src = 7 AND rel_type IN ('SIMILAR_RISK', 'SIMILAR_DESCRIPTION') GROUP BY 1
)
SELECT dst, round(score + 0.05 * coalesce(shared_tech, 0), 6) AS score, similar_risk_matches, similar_description_matches, coalesce(shared_tech, 0) AS shared_tech
FROM s LEFT JOIN t USING (dst) WHERE round(score + 0.05 * coalesce(shared_tech, 0), 6) >= 0.1 ORDER BY 2 DESC, 1 LIMIT 20""",
}


_TIER = """CASE WHEN embedding_similarity IS NULL THEN 'medium'
    WHEN embedding_similarity >= CASE rel_type WHEN 'HAS_COMPETITOR' THEN 0.35 WHEN 'HAS_PARTNER' THEN 0.5 ELSE 0.55 END THEN 'high'
    WHEN embedding_similarity >= CASE rel_type WHEN 'HAS_COMPETITOR' THEN 0.25 ELSE 0.3 END THEN 'medium' ELSE 'low' END"""

_SHARES = """, e AS (
    SELECT src, dst, 1.0::DOUBLE / count(*) OVER (PARTITION BY src) AS share FROM has_competitor UNION ALL SELECT cik, cik, 0 FROM company
)"""

_CO = """, co AS (SELECT x.technology AS src, y.technology AS dst, count(*)::DOUBLE AS weight FROM uses x JOIN uses y USING (domain) WHERE x.technology <> y.technology GROUP BY 1, 2)"""

_AFFINITY = _CO + """, deg AS (SELECT src, count(*) AS n FROM co GROUP BY 1), jac AS (
    SELECT a, b, shared / (x.n + y.n - shared) AS score FROM (SELECT x.src AS a, y.src AS b, count(*) AS shared FROM co x JOIN co y ON x.dst = y.dst WHERE x.src < y.src GROUP BY 1, 2) JOIN deg x ON x.src = a JOIN deg y ON y.src = b
), affinity AS (
    SELECT src, dst, score FROM (
        SELECT *, row_number() OVER (PARTITION BY src ORDER BY round(score, 9) DESC, dst) AS r
        FROM (SELECT a AS src, b AS dst, score FROM jac WHERE score >= 0.1 UNION ALL SELECT b, a, score FROM jac WHERE score >= 0.1)
    ) WHERE r <= 50
)"""


def _adoption(targets: str, top: int) -> str:
    return _CO + f""", rare AS (
    SELECT technology FROM uses WHERE {targets} GROUP BY 1 HAVING count(*) <= 0.5 * (SELECT count(DISTINCT domain) FROM uses)
), nodes AS (SELECT DISTINCT technology AS node FROM uses), share AS (
    SELECT src, dst, weight / sum(weight) OVER (PARTITION BY src) AS share FROM co UNION ALL SELECT node, node, 0 FROM nodes
), ppr(it, source, node, rank) AS (
    SELECT 0, technology, node, CASE WHEN node = technology THEN 0.15::DOUBLE ELSE 0::DOUBLE END FROM rare, nodes
    UNION ALL
    SELECT it + 1, source, dst, CASE WHEN dst = source THEN 0.15::DOUBLE ELSE 0::DOUBLE END + 0.85 * sum(rank * share) FROM ppr JOIN share ON src = node WHERE it < 20 GROUP BY it, source, dst
), scored AS (
    SELECT source, domain, round(max(rank) * (1 + ln(count(*) + 1)), 6) AS score FROM ppr JOIN uses ON technology = node WHERE it = 20 GROUP BY 1, 2
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, domain) AS r FROM scored s WHERE NOT EXISTS (SELECT 1 FROM uses u WHERE u.domain = s.domain AND u.technology = s.source)
)
"""


_STRIP = "regexp_replace(regexp_replace({0}, '^\\s+', ''), '\\s+$', '')"

_CHUNKS = f""", base AS (SELECT doc_id, text, length(text) AS n, greatest(0, ceil((length(text) - 1000) / 800.0))::BIGINT AS k FROM documents WHERE text IS NOT NULL),
starts AS (
    SELECT doc_id, text, n, unnest(list_concat(list_transform(range(0, k + 1), lambda i: i * 800), CASE WHEN n - 200 > k * 800 THEN [n - 200] ELSE [] END)) AS s FROM base WHERE n >= 100
), pieces AS (SELECT doc_id, s, {_STRIP.format("substr(text, s + 1, 1000)")} AS text FROM starts), chunks AS (
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS chunk_index, text FROM pieces WHERE length(text) >= 100
    UNION ALL SELECT doc_id, 0, text FROM base WHERE n < 100
)
"""

_VECTORS = ", v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), s AS (SELECT v.vec_id, round(list_cosine_similarity(v.e, q.e), 6) AS score FROM v, (SELECT e FROM v WHERE vec_id = 3) q)\n"

_EXTENDED = """, industry_edges AS (
    SELECT a, b, min_by(method, rank) AS method FROM (
        SELECT x.cik AS a, y.cik AS b, 'SIC' AS method, 0 AS rank FROM company x JOIN company y ON x.sic = y.sic AND x.cik < y.cik
        UNION ALL SELECT x.cik, y.cik, 'INDUSTRY', 1 FROM company x JOIN company y ON x.industry = y.industry AND x.cik < y.cik
        UNION ALL SELECT x.cik, y.cik, 'SECTOR', 2 FROM company x JOIN company y ON x.sector = y.sector AND x.cik < y.cik
    ) GROUP BY 1, 2
), every AS (
    SELECT src, dst, rel_type, score, NULL::VARCHAR AS method FROM similar_edges WHERE rel_type <> 'SIMILAR_INDUSTRY'
    UNION ALL SELECT a, b, 'SIMILAR_INDUSTRY', 1.0, method FROM industry_edges
    UNION ALL SELECT key1, key2, 'SIMILAR_KEYWORD', round(score, 6), NULL FROM keyword_pairs
    UNION ALL SELECT src, dst, 'HAS_COMPETITOR', confidence, NULL FROM has_competitor
), extended AS (SELECT CASE WHEN src = 7 THEN dst ELSE src END AS dst, rel_type, score::DOUBLE AS score, method FROM every WHERE src = 7 OR dst = 7)
"""

_PAGERANK = _SHARES + """, pr(it, node, rank) AS (
    SELECT 0, cik, 0.15::DOUBLE FROM company
    UNION ALL
    SELECT it + 1, dst, 0.15 + 0.85 * sum(rank * share) FROM pr JOIN e ON src = node WHERE it < 20 GROUP BY it, dst
)
"""

OPERATORS = {
    "sim18_extended_similar": _EXTENDED + """, y AS (
    SELECT dst, count(*) AS edge_count, sum(score * CASE rel_type WHEN 'HAS_COMPETITOR' THEN 4.0 WHEN 'SIMILAR_DESCRIPTION' THEN 0.8 WHEN 'SIMILAR_RISK' THEN 0.8 WHEN 'SIMILAR_TECHNOLOGY' THEN 0.3 WHEN 'SIMILAR_SIZE' THEN 0.2 WHEN 'SIMILAR_KEYWORD' THEN 0.1
            ELSE 0.6 * CASE method WHEN 'SIC' THEN 1.2 WHEN 'INDUSTRY' THEN 0.8 ELSE 0.6 END END) AS base,
        count(*) FILTER (rel_type = 'SIMILAR_RISK') AS risk_matches, count(*) FILTER (method = 'SIC') AS sic_matches, count(*) FILTER (rel_type = 'SIMILAR_SIZE') AS z,
        count(*) FILTER (rel_type = 'SIMILAR_DESCRIPTION') AS desc_matches, count(*) FILTER (rel_type = 'SIMILAR_TECHNOLOGY') AS tech_matches, count(*) FILTER (rel_type = 'HAS_COMPETITOR') AS competitor_matches
    FROM extended GROUP BY 1
)
SELECT dst, ticker, name, sector, industry, edge_count, round(base + CASE WHEN sic_matches > 0 AND z > 0 THEN 0.2 ELSE 0 END + CASE WHEN risk_matches > 0 AND sic_matches > 0 THEN 0.2 ELSE 0 END, 6) AS weighted_score,
    risk_matches, sic_matches, desc_matches, tech_matches, competitor_matches
FROM y JOIN company ON cik = dst
ORDER BY weighted_score DESC, competitor_matches DESC, (industry = (SELECT industry FROM company WHERE cik = 7)) DESC, risk_matches DESC, sic_matches DESC, desc_matches DESC, tech_matches DESC, edge_count DESC, dst LIMIT 20""",
    "sim20_similarity_breakdown": _EXTENDED + """, t AS (SELECT technology FROM company_uses WHERE cik = 7 INTERSECT SELECT technology FROM company_uses WHERE cik = 9)
SELECT rel_type, score, method, (SELECT count(*) FROM t) AS shared_tech_count, coalesce((SELECT array_to_string(list_sort(list(technology)), ',') FROM t), '') AS shared_technologies
FROM extended WHERE dst = 9 AND rel_type LIKE 'SIMILAR%'""",
    "gra01_pagerank": _PAGERANK + "SELECT node, round(rank, 6) AS rank FROM pr WHERE it = 20",
    "gra03_degrees": f"SELECT cik AS node, i.n AS in_degree, o.n AS out_degree FROM company LEFT JOIN {_IN} i USING (cik) LEFT JOIN {_OUT} o USING (cik)",
    "gra06_adoption": _adoption("true", 50) + "SELECT domain, source AS technology, score FROM ranked WHERE r <= 50",
    "joi16_typed_paths": """, f AS (SELECT src, dst, 'HAS_COMPETITOR' AS t FROM has_competitor UNION ALL SELECT src, dst, 'HAS_SUPPLIER' FROM has_supplier),
u AS (SELECT src, dst, t, least(src, dst) || '|' || greatest(src, dst) || '|' || t AS id FROM f UNION ALL SELECT dst, src, t, least(src, dst) || '|' || greatest(src, dst) || '|' || t FROM f)
SELECT node, hops, types, count(*) AS paths FROM (
    SELECT dst AS node, 1::BIGINT AS hops, t AS types FROM u WHERE src = 7
    UNION ALL SELECT y.dst, 2, x.t || '>' || y.t FROM u x JOIN u y ON x.dst = y.src AND x.id <> y.id WHERE x.src = 7
) GROUP BY 1, 2, 3""",
    "sim07_risk_pairs": "SELECT key1, key2, round(score, 6) AS score FROM risk_pairs",
    "sim10_industry_pairs": "SELECT a, b, method FROM class_pairs",
    "sim13_size_pairs": "SELECT a, b, method, bucket::BIGINT AS bucket FROM size_pairs",
    "sim14_technology_pairs": """SELECT least(src, dst) AS cik1, greatest(src, dst) AS cik2, round(max(score), 6) AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY src ORDER BY round(score, 9) DESC, dst) AS r
    FROM (SELECT a AS src, b AS dst, score FROM tech_jaccard WHERE score >= 0.1 UNION ALL SELECT b, a, score FROM tech_jaccard WHERE score >= 0.1)
) WHERE r <= 5 GROUP BY 1, 2""",
    "sim15_affinity": _AFFINITY + "SELECT src, dst, round(score, 6) AS score FROM affinity",
    "sim16_via_domains": """, sz AS (SELECT domain, count(*) AS n FROM uses GROUP BY 1), dp AS (
    SELECT a, b, shared / (x.n + y.n - shared) AS score FROM (SELECT x.domain AS a, y.domain AS b, count(*) AS shared FROM uses x JOIN uses y USING (technology) WHERE x.domain < y.domain GROUP BY 1, 2) JOIN sz x ON x.domain = a JOIN sz y ON y.domain = b
), both_ways AS (SELECT a, b, score FROM dp WHERE score >= 0.6 UNION ALL SELECT b, a, score FROM dp WHERE score >= 0.6)
SELECT x.src, y.src AS dst, round(max(score), 6) AS score, count(*) AS domain_pair_count FROM both_ways JOIN has_domain x ON x.dst = a JOIN has_domain y ON y.dst = b WHERE x.src <> y.src GROUP BY 1, 2""",
    "qry15_co_occurrence": _AFFINITY + "SELECT src, dst, round(score, 6) AS score FROM affinity WHERE score > 0.3 ORDER BY round(score, 6) DESC, src, dst LIMIT 20",
    "qry21_likely_adopters": _adoption("technology = 'Brand#1/ECONOMY'", 10) + "SELECT domain, score FROM ranked WHERE r <= 10",
    "qry28_next_chunk": _CHUNKS + "SELECT doc_id || '_chunk_' || chunk_index AS src, doc_id || '_chunk_' || (chunk_index + 1) AS dst FROM chunks x WHERE EXISTS (SELECT 1 FROM chunks y WHERE y.doc_id = x.doc_id AND y.chunk_index = x.chunk_index + 1)",
    "qry30_candidate_review": f"SELECT replace(rel_type, 'HAS_', 'CANDIDATE_') AS rel_type, src, dst, embedding_similarity FROM all_edges WHERE {_TIER} = 'medium' ORDER BY embedding_similarity DESC, 1, src, dst LIMIT 25",
    "snk01_latest_observations": "SELECT user_id, arg_max(value, (ts, event_id)) FILTER (event_type = 'click') AS click, arg_max(value, (ts, event_id)) FILTER (event_type = 'error') AS error, arg_max((props->>'k')::BIGINT, (ts, event_id)) FILTER (props->>'k' IS NOT NULL) AS k FROM events GROUP BY 1",
    "snk05_filled_companies": "SELECT cik, coalesce(revenue, min(revenue) OVER (PARTITION BY sic)) AS revenue FROM company",
    "snk06_upserted_companies": "SELECT cik, coalesce(CASE WHEN c_acctbal > 0 THEN c_acctbal END, revenue) AS revenue, c_mktsegment AS segment FROM company LEFT JOIN customer ON cik = c_custkey",
    "snk07_merged_companies": ", x AS (SELECT cik, CASE WHEN cik % 3 = 0 THEN employees::DOUBLE END AS s, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS m FROM company LEFT JOIN customer ON cik = c_custkey) SELECT cik, coalesce(s, m) AS registry_first, coalesce(m, s) AS market_first, concat_ws(',', CASE WHEN s IS NOT NULL THEN 'SEC' END, CASE WHEN m IS NOT NULL THEN 'MARKET' END) AS data_source FROM x",
    "snk13_documents": _CHUNKS + "SELECT doc_id, count(*) AS chunk_count FROM chunks GROUP BY 1",
    "snk15_duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "snk16_cleanup_counts": f"SELECT rel_type, CASE {_TIER} WHEN 'high' THEN 'keep' WHEN 'medium' THEN 'convert' ELSE 'delete' END AS action, count(*) AS n FROM all_edges GROUP BY 1, 2",
    "src05_observation_counts": "SELECT count(DISTINCT user_id) AS total, count(DISTINCT user_id) FILTER (value > 10) AS with_value, count(DISTINCT user_id) FILTER (event_type <> 'click') AS with_kind FROM events",
    "src12_directory": "SELECT lpad((c_custkey % 700)::VARCHAR, 10, '0') AS cik, 'T' || min(c_custkey) AS ticker, arg_min(c_name, c_custkey) AS name FROM customer GROUP BY c_custkey % 700",
    "src18_filers": "SELECT cik, name FROM company WHERE cik IN (SELECT src FROM has_competitor) AND cik NOT IN (SELECT src FROM has_supplier WHERE mentions > 1)",
    "ent01_sentences": ", parts AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS p FROM documents), one AS (SELECT doc_id, unnest(range(0, len(p))) AS place, unnest(p) AS sentence FROM parts) SELECT doc_id, place, md5(sentence) AS sentence FROM one WHERE lower(sentence) LIKE '%thehe%' OR lower(sentence) LIKE '%lyou%' OR lower(sentence) LIKE '%queci%'",
    "ent37_tiers": f"SELECT rel_type, src, dst, {_TIER} AS tier FROM all_edges",
    "rag01_chunks": _CHUNKS + "SELECT doc_id || '_chunk_' || chunk_index AS chunk_id, chunk_index, length(text) AS n_chars, md5(text) AS digest FROM chunks",
    "rag04_search": _VECTORS + "SELECT vec_id, score FROM s WHERE score >= 0.2 ORDER BY score DESC, vec_id LIMIT 10",
    "emb02_aggregated": ", x AS (SELECT label, exp(-0.2 * (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1)) AS w, embedding::DOUBLE[] AS e FROM embeddings), y AS (SELECT label, w, unnest(range(0, len(e))) AS pos, unnest(e) AS v FROM x) SELECT label, pos, round(avg(v), 6) AS average, round(sum(v * w) / sum(w), 6) AS weighted, round(max(v), 6) AS maximum FROM y GROUP BY 1, 2",
    "emb06_token_counts": "SELECT source, sum(length(text) // 4)::BIGINT AS tokens FROM documents GROUP BY 1",
    "emb08_text_hash": f"SELECT doc_id, CASE WHEN text IS NULL OR {_STRIP.format('text')} = '' THEN '' ELSE sha256({_STRIP.format('text')}) END AS digest FROM documents",
    "emb05_worklist": f", h AS (SELECT doc_id, text, source, CASE WHEN {_STRIP.format('text')} = '' THEN '' ELSE sha256({_STRIP.format('text')}) END AS digest FROM documents) SELECT doc_id, digest, length(text) // 4 <= 300 AS whole FROM h WHERE length(text) >= 200 AND digest NOT IN (SELECT digest FROM h WHERE source = 'src1')",
    "txt08_domains": "SELECT page_id, regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/?#:]+)', 1), '^www[.]', '') AS host, regexp_extract(regexp_extract(lower(url), '^[a-z]+://([^/?#:]+)', 1), '([^.]+[.][^.]+)$', 1) AS domain FROM pages",
}


def _candidates(quoted: bool) -> str:
    """Letters beyond ASCII are letters to a word's edge, but in no name."""
    found = [("capitalized", r"\b([A-Z][a-zA-Z&.\-]*(?:\s+[A-Z][a-zA-Z&.\-]*){0,3})\b"), ("ticker", r"\b([A-Z]{2,5})\b")] + [("quoted", '"([^"]{2,50})"')] * quoted
    each = " UNION ALL ".join(
        f"SELECT doc_id, {rank} AS rank, '{name}' AS pattern, generate_subscripts(c, 1) - 1 AS place, unnest(c) AS candidate FROM (SELECT doc_id, regexp_extract_all({'text' if name == 'quoted' else 'plain'}, '{pattern}', 1) AS c FROM told)"
        for rank, (name, pattern) in enumerate(found)
    )
    return f""", told AS (SELECT doc_id, '"The Firm" and ' || text AS text, regexp_replace('"The Firm" and ' || text, '[À-ÖØ-öø-ÿ]', '_', 'g') AS plain FROM documents), hits AS ({each})
SELECT doc_id, rank::BIGINT AS rank, place::BIGINT AS place, candidate, pattern FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id, lower(candidate) ORDER BY rank, place) AS r FROM hits WHERE length(candidate) >= 2 AND (pattern <> 'quoted' OR regexp_matches(candidate, '[A-Z]'))
) WHERE r = 1"""


_BETWEEN = """, ways AS (SELECT DISTINCT src, dst FROM has_competitor WHERE src <> dst), reach(s, v, d) AS (
    SELECT cik, cik, 0 FROM company UNION SELECT s, dst, d + 1 FROM reach JOIN ways ON src = v WHERE d < 30
), far AS (SELECT s, v, min(d) AS d FROM reach GROUP BY 1, 2), counted(s, v, d, n) AS (
    SELECT cik, cik, 0, 1::DOUBLE FROM company
    UNION ALL SELECT c.s, w.dst, c.d + 1, sum(c.n) FROM counted c JOIN ways w ON w.src = c.v JOIN far f ON f.s = c.s AND f.v = w.dst AND f.d = c.d + 1 GROUP BY c.s, w.dst, c.d
), told AS (
    SELECT x.v AS node, sum(x.n * y.n / z.n) AS b FROM counted x JOIN counted y ON y.s = x.v JOIN counted z ON z.s = x.s AND z.v = y.v AND z.d = x.d + y.d WHERE x.s <> x.v AND y.v <> x.v AND y.v <> x.s GROUP BY 1
)
"""


OPERATORS |= {
    "rag03_page_text": r""", shown AS (SELECT page_id, regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', '<x>', 'g') AS h FROM pages), nodes AS (
    SELECT page_id, list_transform(regexp_split_to_array(h, '(?s)<[^>]*>'), lambda t: replace(regexp_replace(replace(replace(replace(t, '&quot;', chr(34)), '&copy;', chr(169)), '&middot;', chr(183)), '&amp;?', chr(1), 'g'), chr(1), '&')) AS ts FROM shown
), lines AS (SELECT page_id, list_filter(list_transform(flatten(list_transform(ts, lambda t: string_split(t, chr(10)))), lambda l: regexp_replace(l, '^\s+|\s+$', '', 'g')), lambda l: l <> '') AS ls FROM nodes)
SELECT page_id, CASE WHEN length(array_to_string(ls, chr(10))) >= 100 THEN array_to_string(ls, chr(10)) END AS text FROM lines""",
    "ent03_candidates": _candidates(False),
    "ent05_quoted_candidates": _candidates(True),
    "txt10_industry_codes": """, c AS (SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN (c_custkey % 20)::VARCHAR WHEN 1 THEN (c_custkey * 7)::VARCHAR ELSE '' END AS d FROM customer)
SELECT id, CASE WHEN length(d) >= 2 THEN lpad(left(d, 4), 4, '0') END AS sic, CASE WHEN length(d) >= 2 THEN lpad(left(d, 6), 6, '0') END AS naics FROM c""",
    "gra04_betweenness": _BETWEEN + "SELECT cik AS node, round(coalesce(b, 0), 6) AS betweenness FROM company LEFT JOIN told ON node = cik",
    "gra05_measures": _PAGERANK + _BETWEEN + f"""SELECT cik AS node, i.n AS in_degree, o.n AS out_degree, round(rank, 6) AS rank, round(coalesce(b, 0), 6) AS betweenness
FROM company LEFT JOIN {_IN} i USING (cik) LEFT JOIN {_OUT} o USING (cik) JOIN pr ON pr.node = cik AND it = 20 LEFT JOIN told t ON t.node = cik""",
}


def oracle_sql() -> dict[str, str]:
    from . import oracles_entities, oracles_ingest

    return {k: GRAPH + v for k, v in (CATALOGUE | OPERATORS | oracles_ingest.INGEST | oracles_entities.ENTITIES).items()}
