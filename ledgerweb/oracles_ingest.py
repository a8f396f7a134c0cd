"""Sources, sinks and loaders in DuckDB SQL; ``oracles`` puts the graph before each."""

from __future__ import annotations

_STATUS = """, status AS (
    SELECT c_custkey AS id, CASE WHEN c_custkey % 5 <> 0 THEN 'd' || (c_custkey % 300) || '.com' END AS final_domain, 'www.d' || (c_custkey % 300) || '.com' AS initial_domain,
        200 + c_custkey % 3 * 100 AS http_status, c_custkey % 7 / 10 AS response_time, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey * 86400000 END AS ms, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS title, c_mktsegment AS keywords
    FROM customer
), whois AS (SELECT s_suppkey * 2 AS id, s_suppkey % 3 * 1000000000 AS created, s_name AS registrar FROM supplier
), seen AS (
    SELECT p_partkey % 900 AS id, CASE WHEN p_partkey % 11 = 0 THEN '' WHEN p_partkey % 13 <> 0 THEN p_brand || '/' || p_type END AS technology_name, CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE 'other' END AS technology_category FROM part
), tech_nodes AS (SELECT technology_name AS technology, min(technology_category) AS category FROM seen WHERE technology_name IS NOT NULL AND technology_name <> '' GROUP BY 1)
"""

_ISO = "CASE WHEN {0} > 0 THEN strftime(make_timestamp({0} * 1000), '%Y-%m-%dT%H:%M:%SZ') END"

_ANSWERS = """, asked AS (
    SELECT c_custkey % 60 AS cik, (['yfinance', 'sec_edgar', 'sec_edgar_text', 'finviz', 'finnhub', 'rumour'])[c_custkey % 6 + 1] AS source, ([0.9, 0.85, 0.75, 0.7, 0.6, 0.0])[c_custkey % 6 + 1]::DOUBLE AS sure,
        CASE WHEN c_custkey % 7 < 2 THEN NULL WHEN c_custkey % 7 = 2 THEN 'x' || (c_custkey % 20) || '.co.uk' ELSE 'shop' || (c_custkey % 20) || '.com' END AS domain
    FROM customer
), answers AS (SELECT cik, domain, source, CASE WHEN domain IS NULL THEN 0.0::DOUBLE ELSE sure END AS confidence FROM asked)
"""

_PATHS = ", files AS (SELECT '/data/' || (c_custkey % 40) || '/f' || c_custkey || CASE c_custkey % 4 WHEN 0 THEN '.html' WHEN 1 THEN '.xml' WHEN 2 THEN '.htm' ELSE '.txt' END AS path, c_custkey % 40 AS cik, c_custkey * 7919 % 1000003 AS modified, c_custkey % 4 AS kind FROM customer)\n"

_ARCHIVES = """, archives AS (
    SELECT c_custkey, c_custkey % 50 AS cik, CASE WHEN c_custkey % 9 = 0 THEN 'batch_' || c_custkey || '.tar' ELSE lpad(c_custkey::VARCHAR, 10, '0') || lpad((c_custkey % 24)::VARCHAR, 2, '0') || lpad((c_custkey * 17 % 999999)::VARCHAR, 6, '0') || '.tar' END AS path FROM customer
)
"""

_STRIP = "regexp_replace(regexp_replace({0}, '^\\s+', ''), '\\s+$', '')"

_FILED = f""", owned AS (
    SELECT doc_id % (n + 5) AS cik, nullif(doc_id // (n + 5), 0) AS year, doc_id, text FROM documents, n_company
), sections AS (
    SELECT cik, year, doc_id, 'business_description' AS section, 'Item 1: Business' AS label, text FROM owned WHERE doc_id % 3 <> 0 AND text <> ''
    UNION ALL SELECT cik, year, doc_id, 'risk_factors', 'Item 1A: Risk Factors', text FROM owned WHERE doc_id % 3 <> 1 AND text <> ''
), base AS (SELECT *, length(text) AS n, greatest(0, ceil((length(text) - 1000) / 800.0))::BIGINT AS k FROM sections),
starts AS (
    SELECT *, unnest(list_concat(list_transform(range(0, k + 1), lambda i: i * 800), CASE WHEN n - 200 > k * 800 THEN [n - 200] ELSE [] END)) AS s FROM base WHERE n >= 100
), pieces AS (SELECT cik, year, doc_id, section, label, s, {_STRIP.format("substr(text, s + 1, 1000)")} AS text FROM starts), chunks AS (
    SELECT cik, year, doc_id, section, label, row_number() OVER (PARTITION BY doc_id, section ORDER BY s) - 1 AS chunk_index, text FROM pieces WHERE length(text) >= 100
    UNION ALL SELECT cik, year, doc_id, section, label, 0, text FROM base WHERE n < 100
), nodes AS (
    SELECT cik || '_' || section || '_' || coalesce(year::VARCHAR, 'unknown') AS doc_id, cik, section, year, 'T' || cik AS ticker, 'C' || arg_min(doc_id, chunk_index) AS name, count(*) AS chunk_count FROM chunks GROUP BY cik, section, year
)
"""

INGEST = {
    "src01_domain_rows": _STATUS + f"SELECT DISTINCT initial_domain AS domain, final_domain, http_status AS status, 'seen' AS status_description, response_time, title, registrar, {_ISO.format('ms')} AS timestamp, {_ISO.format('created')} AS creation_date, NULL::VARCHAR AS expiration_date FROM status LEFT JOIN whois USING (id) WHERE final_domain IS NOT NULL",
    "src02_technology_rows": _STATUS + "SELECT DISTINCT final_domain, technology_name, technology_category FROM status JOIN seen USING (id) WHERE technology_name IS NOT NULL AND technology_name <> ''",
    "src03_store_counts": _STATUS + "SELECT (SELECT count(DISTINCT final_domain) FROM status) AS domains, count(DISTINCT technology_name) AS technologies, count(*) AS uses FROM seen WHERE technology_name <> ''",
    "src06_filing_paths": _PATHS + "SELECT path FROM files WHERE kind < 3 ORDER BY path",
    "src07_newest_filings": _PATHS + "SELECT cik::VARCHAR AS cik, arg_max(path, (modified, path)) AS path FROM files WHERE kind IN (0, 2) GROUP BY 1",
    "src09_filing_dates": """, d AS (SELECT c_custkey AS id, DATE '2001-02-03' + (c_custkey * 37 % 7000)::INTEGER AS day FROM customer)
SELECT id, CASE WHEN id % 4 = 2 THEN '20' || lpad((id % 24)::VARCHAR, 2, '0') || '-01-01' ELSE strftime(day, '%Y-%m-%d') END AS filed, CASE WHEN id % 4 = 2 THEN '0000320193-' || lpad((id % 24)::VARCHAR, 2, '0') || '-000077' ELSE '' END AS accession FROM d""",
    "src10_latest_archives": _ARCHIVES + "SELECT cik, path FROM (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY CASE WHEN c_custkey % 5 <> 0 THEN DATE '2010-01-01' + (c_custkey * 31 % 3000)::INTEGER ELSE DATE '1900-01-01' END DESC, path) AS r FROM archives WHERE c_custkey % 6 > 0) WHERE r = 1",
    "src11_archive_order": _ARCHIVES + "SELECT path, CASE WHEN c_custkey % 9 = 0 THEN 99 ELSE c_custkey % 24 END::BIGINT AS year, CASE WHEN c_custkey % 9 = 0 THEN c_custkey * 10 ELSE c_custkey * 17 % 999999 END::BIGINT AS number FROM archives",
    "src13_known_companies": "SELECT DISTINCT c_custkey % 100 AS cik, CASE WHEN c_custkey % 2 = 0 THEN 't' ELSE '' END AS ticker, c_mktsegment AS name FROM customer",
    "src14_registry_rows": "SELECT s_suppkey AS cik, CASE WHEN s_suppkey % 90 + 1 >= 10 THEN lpad((s_suppkey % 90 + 1)::VARCHAR, 4, '0') END AS sic, CASE WHEN s_suppkey % 2 = 0 THEN left((s_suppkey + 111000)::VARCHAR, 6) END AS naics, s_name AS name FROM supplier WHERE s_suppkey % 10 <> 9",
    "src15_market_rows": "SELECT 'T' || s_suppkey AS ticker, s_acctbal AS price, CASE WHEN s_suppkey % 3 <> 0 THEN 'Tech' END AS sector, NULL::VARCHAR AS industry, NULL::VARCHAR AS country, s_suppkey * 1000.0::DOUBLE AS market_cap, NULL::DOUBLE AS revenue, s_suppkey AS employees FROM supplier WHERE s_suppkey % 4 <> 0",
    "src16_source_answers": _ANSWERS + "SELECT * FROM answers",
    "src16_domain_votes": _ANSWERS + "SELECT cik, domain, source, confidence FROM (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY confidence DESC, source, domain) AS r FROM answers WHERE domain IS NOT NULL) WHERE r = 1",
    "src17_annual_filers": "SELECT c_custkey AS cik, NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) OR EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderkey % 3 = 0 AND o_orderdate::DATE BETWEEN DATE '1995-01-01' AND DATE '1995-06-30') AS files FROM customer",
    "snk02_technology_nodes": _STATUS + "SELECT * FROM tech_nodes",
    "snk02_uses_edges": _STATUS + "SELECT DISTINCT final_domain AS domain, technology_name AS technology FROM status JOIN seen USING (id) WHERE final_domain IN (SELECT final_domain FROM status WHERE http_status = 200) AND technology_name IN (SELECT technology FROM tech_nodes WHERE category <> 'other')",
    "snk03_company_rows": """, p AS (SELECT *, cik % 4 <> 0 AS parsed, cik % 4 <> 0 AND cik % 5 <> 0 AS numbered, cik % 4 <> 0 AND cik % 2 = 0 AS dated FROM company)
SELECT lpad(cik::VARCHAR, 10, '0') AS cik, ticker, name, CASE WHEN parsed AND cik % 3 <> 0 THEN name END AS description, CASE WHEN parsed AND cik % 3 <> 0 THEN 'filing' END AS description_source, CASE WHEN parsed THEN 'risk' END AS risk_factors,
    CASE WHEN dated THEN '2023-04-05' ELSE '2020-01-02' END AS filing_date, CASE WHEN dated THEN 2023 ELSE 2020 END::BIGINT AS filing_year,
    CASE WHEN numbered THEN lpad(cik::VARCHAR, 10, '0') || '-23-' || lpad((cik * 3)::VARCHAR, 6, '0') ELSE 'old' END AS accession_number, CASE WHEN parsed THEN '2022-12-31' END AS fiscal_year_end,
    CASE WHEN numbered THEN 'https://www.sec.gov/Archives/edgar/data/' || cik || '/' || lpad(cik::VARCHAR, 10, '0') || '23' || lpad((cik * 3)::VARCHAR, 6, '0') || '/' ELSE 'there' END AS filing_url
FROM p""",
    "snk04_has_domain_edges": _STATUS + "SELECT DISTINCT cik AS src, final_domain AS dst FROM company JOIN status ON final_domain = 'd' || (cik % 50) || '.com' WHERE cik % 3 <> 0 AND http_status = 200",
    "snk08_clean_rows": "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 2 THEN ' ' || c_name END AS name, c_acctbal FROM customer",
    "snk09_similar_both_ways": "SELECT src, dst, 'HAS_SUPPLIER' AS rel_type, 1.0::DOUBLE AS score FROM has_supplier UNION ALL SELECT key1, key2, 'SIMILAR_RISK', round(score, 6) FROM risk_pairs UNION ALL SELECT key2, key1, 'SIMILAR_RISK', round(score, 6) FROM risk_pairs",
    "snk10_class_edges": """, one AS (
    SELECT x.cik AS src, y.cik AS dst, 'SIMILAR_INDUSTRY' AS rel_type, 'SECTOR' AS method, x.sector AS classification FROM company x JOIN company y ON x.sector = y.sector AND x.cik < y.cik
    UNION ALL SELECT a, b, 'SIMILAR_SIZE', method, bucket::VARCHAR FROM size_pairs
)
SELECT *, 1.0::DOUBLE AS score FROM one UNION ALL SELECT dst, src, rel_type, method, classification, 1.0 FROM one""",
    "snk11_deleted_edges": "SELECT count(*) FILTER (rel_type <> 'HAS_PARTNER') AS left, (count(*) FILTER (rel_type = 'HAS_PARTNER'))::INTEGER AS gone FROM all_edges",
    "snk12_relation_edges": """SELECT src, dst, rel_type, CASE WHEN src % 3 = 0 THEN greatest(0.6, CASE WHEN mentions > 1 THEN confidence ELSE 0.5 END) ELSE CASE WHEN mentions > 1 THEN confidence ELSE 0.5 END END::DOUBLE AS confidence,
    left(rpad('m' || src, 120, 'x'), 100) AS raw_mention, CASE WHEN dst % 2 = 0 THEN NULL ELSE 'context' END AS context FROM all_edges""",
    "snk13_document_nodes": _FILED + "SELECT * FROM nodes",
    "snk14_company_documents": _FILED + "SELECT cik AS src, doc_id AS dst FROM nodes WHERE cik IN (SELECT cik FROM company)",
    "snk17_merged_filings": "SELECT cik, CASE WHEN cik % 6 = 0 THEN 'new' WHEN cik % 2 = 0 THEN 'old' END AS business, CASE WHEN cik % 4 = 0 THEN 'site.com' END AS website, CASE WHEN cik % 3 = 0 THEN 'risk' END AS risk_factors FROM company WHERE cik % 2 = 0 OR cik % 3 = 0",
    "rag02_section_chunks": _FILED + "SELECT cik || '_' || section || '_' || coalesce(year::VARCHAR, 'unknown') || '_chunk_' || chunk_index AS chunk_id, cik || '_' || section || '_' || coalesce(year::VARCHAR, 'unknown') AS doc_id, chunk_index, '{\"section\":\"' || label || '\"}' AS metadata, md5(text) AS digest FROM chunks",
    "ent42_verdicts": "SELECT rel_type, src, dst, CASE WHEN confidence < 0.7 THEN 'uncertain' WHEN mentions % 2 = 0 THEN 'confirmed' ELSE 'rejected' END AS verdict, left(sha256('said ' || mentions || '|' || src || '|' || dst || '|' || rel_type), 16) AS key FROM all_edges",
}
