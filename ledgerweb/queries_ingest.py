"""Registered queries of sources, sinks and loaders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import text
from .graph import BusinessGraph, blank_to_null
from .plans import catalogue, relations, retrieval
from .sources import filings, landed, loaders, observations


def _status(g: BusinessGraph) -> DataFrame:
    """Observations of domains, made of the customers."""
    k = F.col("c_custkey")
    return g.table("customer").select(
        k.alias("id"), F.when(k % 5 != 0, F.concat(F.lit("d"), (k % 300).cast("string"), F.lit(".com"))).alias("final_domain"),
        F.concat(F.lit("www.d"), (k % 300).cast("string"), F.lit(".com")).alias("initial_domain"), (F.lit(200) + k % 3 * 100).alias("http_status"), F.lit("seen").alias("http_status_text"),
        (k % 7 / 10).alias("response_time_seconds"), F.when(k % 4 != 0, k * 86_400_000).alias("observed_at_ms"), F.when(k % 2 == 0, F.col("c_name")).alias("title"), F.col("c_mktsegment").alias("keywords"),
    )


def _whois(g: BusinessGraph) -> DataFrame:
    k = F.col("s_suppkey")
    return g.table("supplier").select(k.alias("id"), (k * 2).alias("url_status_id"), (k % 3 * 1_000_000_000).alias("creation_date_ms"), F.lit(None).cast("long").alias("expiration_date_ms"), F.col("s_name").alias("registrar"))


def _seen_technologies(g: BusinessGraph) -> DataFrame:
    k = F.col("p_partkey")
    named = F.when(k % 11 == 0, "").when(k % 13 != 0, F.concat_ws("/", "p_brand", "p_type"))
    return g.table("part").select(k.alias("id"), (k % 900).alias("url_status_id"), named.alias("technology_name"), F.when(k % 2 == 0, F.col("p_type")).otherwise("other").alias("technology_category"))


def domain_rows(g: BusinessGraph) -> DataFrame:
    out = observations.observed_domains(_status(g), _whois(g))
    return out.select("domain", "final_domain", "status", "status_description", "response_time", "title", "registrar", "timestamp", "creation_date", "expiration_date")


def technology_rows(g: BusinessGraph) -> DataFrame:
    return observations.observed_technologies(_status(g), _seen_technologies(g))


def _paths(g: BusinessGraph) -> DataFrame:
    k = F.col("c_custkey")
    end = F.when(k % 4 == 0, ".html").when(k % 4 == 1, ".xml").when(k % 4 == 2, ".htm").otherwise(".txt")
    return g.table("customer").select(F.concat(F.lit("/data/"), (k % 40).cast("string"), F.lit("/f"), k.cast("string"), end).alias("path"), F.timestamp_seconds(k * 7919 % 1_000_003).alias("modificationTime"))


def _archive_names(g: BusinessGraph) -> DataFrame:
    k = F.col("c_custkey")
    named = F.concat(F.lpad(k.cast("string"), 10, "0"), F.lpad((k % 24).cast("string"), 2, "0"), F.lpad((k * 17 % 999_999).cast("string"), 6, "0"), F.lit(".tar"))
    return g.table("customer").select((k % 50).alias("cik"), F.when(k % 9 == 0, F.concat(F.lit("batch_"), k.cast("string"), F.lit(".tar"))).otherwise(named).alias("path"), k)


def archive_order(g: BusinessGraph) -> DataFrame:
    o = filings.archive_order(F.col("path"), F.col("c_custkey") * 10)
    return _archive_names(g).select("path", o["year"].cast("long").alias("year"), o["number"].alias("number"))


def latest_archives(g: BusinessGraph) -> DataFrame:
    k = F.col("c_custkey")
    seen = _archive_names(g).withColumns({"members": (k % 6).cast("int"), "filed": F.when(k % 5 != 0, F.date_add(F.lit("2010-01-01"), (k * 31 % 3000).cast("int")))})
    return filings.latest_archive(seen).select("cik", "path")


def filing_dates(g: BusinessGraph) -> DataFrame:
    k = F.col("c_custkey")
    day = F.date_format(F.date_add(F.lit("2001-02-03"), (k * 37 % 7000).cast("int")), "yyyyMMdd")
    dashed = F.date_format(F.date_add(F.lit("2001-02-03"), (k * 37 % 7000).cast("int")), "yyyy-MM-dd")
    path = F.when(k % 4 == 0, F.concat(F.lit("abc-"), day, F.lit(".htm"))).when(k % 4 == 1, F.concat(F.lit("0000320193"), day, F.lit("x.html"))).when(k % 4 == 2, F.concat(F.lit("0000320193-"), F.lpad((k % 24).cast("string"), 2, "0"), F.lit("-000077.html"))).otherwise(F.concat(F.lit("doc "), dashed, F.lit(".html")))
    return g.table("customer").select(k.alias("id"), path.alias("path")).select("id", text.filing_date(F.col("path")).cast("string").alias("filed"), F.coalesce(text.accession_number(F.col("path")), F.lit("")).alias("accession"))


def registry_rows(g: BusinessGraph) -> DataFrame:
    k = F.col("s_suppkey")
    name = F.when(k % 3 == 0, F.concat(F.lit('["'), "s_name", F.lit('","other"]'))).otherwise(F.concat(F.lit('"'), F.col("s_name"), F.lit('"')))
    body = F.when(k % 10 == 9, "not json").otherwise(F.concat(F.lit('{"sic":"'), (k % 90 + 1).cast("string"), F.lit('","name":'), name, F.when(k % 2 == 0, F.concat(F.lit(',"naics":'), (k + 111000).cast("string"))).otherwise(""), F.lit("}")))
    return landed.registry_info(g.table("supplier").select(k.alias("cik"), body.alias("body")))


def market_rows(g: BusinessGraph) -> DataFrame:
    k = F.col("s_suppkey")
    body = F.to_json(F.struct(F.when(k % 4 != 0, F.col("s_acctbal")).alias("currentPrice"), F.when(k % 3 == 0, "").otherwise("Tech").alias("sector"), (k * 1000.0).alias("marketCap"), k.alias("fullTimeEmployees")))
    return landed.market_info(g.table("supplier").select(F.concat(F.lit("T"), k).alias("ticker"), body.alias("body")))


def _answers(g: BusinessGraph) -> DataFrame:
    k = F.col("c_custkey")
    source = F.element_at(F.array(*(F.lit(s) for s in (*observations.SOURCE_CONFIDENCE, "rumour"))), (k % 6 + 1).cast("int"))
    url = F.when(k % 7 == 0, None).when(k % 7 == 1, "https://www.sec.gov/cgi-bin").when(k % 7 == 2, F.concat(F.lit("http://x"), k % 20, F.lit(".co.uk/a"))).otherwise(F.concat(F.lit("HTTPS://www.Shop"), k % 20, F.lit(".com:443/x?y")))
    return g.table("customer").select((k % 60).alias("cik"), source.alias("source"), url.alias("url"))


def annual_filers(g: BusinessGraph) -> DataFrame:
    o = g.table("orders").select("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, "10-K").otherwise("8-K").alias("form"), F.col("o_orderdate").cast("date").cast("string").alias("day"))
    filed = o.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("form", "day"))).alias("f"))
    cust = g.table("customer").select("c_custkey").join(filed, F.col("c_custkey") == F.col("o_custkey"), "left")
    return cust.select(F.col("c_custkey").alias("cik"), observations.has_annual_report(F.col("f.form"), F.col("f.day"), "1995-01-01", "1995-06-30").alias("files"))


def technology_nodes(g: BusinessGraph) -> DataFrame:
    return loaders.technology_nodes(_seen_technologies(g))


def uses_edges(g: BusinessGraph) -> DataFrame:
    seen = technology_rows(g)
    return loaders.uses_edges(seen, _status(g).where("http_status = 200").select(F.col("final_domain").alias("domain")), technology_nodes(g).where("category <> 'other'"))


def company_rows(g: BusinessGraph) -> DataFrame:
    k = F.col("cik")
    accession = F.concat(F.lpad(k.cast("string"), 10, "0"), F.lit("-23-"), F.lpad((k * 3).cast("string"), 6, "0"))
    parsed = g.company.where(k % 4 != 0).select("cik", F.when(k % 3 == 0, " ").otherwise(F.col("name")).alias("business"), F.lit("risk").alias("risk_factors"), F.when(k % 5 != 0, accession).alias("accession"), F.when(k % 2 == 0, "2023-04-05").alias("filed"), F.lit("2022-12-31").alias("fiscal_year_end"))
    known = g.company.select("cik", F.lit("2020-01-02").cast("date").alias("filing_date"), F.lit(2020).alias("filing_year"), F.lit("old").alias("accession_number"), F.lit(None).cast("date").alias("fiscal_year_end"), F.lit("there").alias("filing_url"))
    raw = g.company.select(F.lpad(k.cast("string"), 10, "0").alias("cik"), F.concat(F.lit(" "), F.lower("ticker")).alias("ticker"), F.concat("name", F.lit(" ")).alias("name"))
    wide = lambda df: df.withColumn("cik", F.lpad(F.col("cik").cast("string"), 10, "0"))
    out = loaders.company_rows(raw, wide(parsed), wide(known))
    return out.withColumns({c: F.col(c).cast("string") for c in ("filing_date", "fiscal_year_end")}).withColumn("filing_year", F.col("filing_year").cast("long"))


def has_domain_edges(g: BusinessGraph) -> DataFrame:
    k = F.col("cik")
    own = g.company.select("cik", F.when(k % 3 != 0, F.concat(F.lit("d"), (k % 50).cast("string"), F.lit(".com"))).alias("domain"))
    return loaders.has_domain_edges(own, _status(g).where("http_status = 200").select(F.col("final_domain").alias("domain")))


def clean_rows(g: BusinessGraph) -> DataFrame:
    k = F.col("c_custkey")
    odd = F.when(k % 3 == 0, "").when(k % 3 == 1, "  ").otherwise(F.concat(F.lit(" "), F.col("c_name")))
    return blank_to_null(g.table("customer").select(k.alias("id"), odd.alias("name"), "c_acctbal"))


def similar_both_ways(g: BusinessGraph) -> DataFrame:
    """A type of likeness replaced by new pairs, in both directions."""
    old = g.edges("HAS_COMPETITOR").select("src", "dst", F.lit("SIMILAR_RISK").alias("rel_type"), F.lit(0.0).alias("score"))
    kept = g.edges("HAS_SUPPLIER").select("src", "dst", F.lit("HAS_SUPPLIER").alias("rel_type"), F.lit(1.0).alias("score"))
    new = loaders.both_directions(catalogue.risk_pairs(g).withColumn("score", F.round("score", 6)), "SIMILAR_RISK", "key1", "key2")
    return loaders.rewritten(old.unionByName(kept), new, "SIMILAR_RISK")


def class_edges(g: BusinessGraph) -> DataFrame:
    from .operators import similarity

    size = similarity.size_pairs(g.company).select("a", "b", "method", F.col("bucket").cast("string").alias("classification"), F.lit(1.0).alias("score"))
    industry = similarity.industry_pairs(g.company, "SECTOR")
    return loaders.both_directions(industry, "SIMILAR_INDUSTRY").unionByName(loaders.both_directions(size, "SIMILAR_SIZE"))


def deleted_edges(g: BusinessGraph) -> DataFrame:
    left, gone = observations.delete_where(g.all_edges(), F.col("rel_type") == "HAS_PARTNER")
    return left.agg(F.count("*").alias("left")).withColumn("gone", F.lit(gone))


def _told(g: BusinessGraph) -> DataFrame:
    """Relations as an extraction gives them: some twice, some of unknown companies, some without a confidence."""
    e = g.all_edges().select("src", "dst", "rel_type", F.when(F.col("mentions") > 1, F.col("confidence")).alias("confidence"), F.rpad(F.concat(F.lit("m"), F.col("src")), 120, "x").alias("raw_mention"), F.when(F.col("dst") % 2 == 0, "").otherwise("context").alias("context"))
    again = e.where("src % 3 = 0").withColumn("confidence", F.lit(0.6))
    return e.unionByName(again).unionByName(e.limit(1).withColumn("dst", F.lit(-1).cast("long")))


def relation_edges(g: BusinessGraph) -> DataFrame:
    return loaders.relation_edges(_told(g), g.company)


def _filings(g: BusinessGraph) -> DataFrame:
    """Companies' filings, whose sections are documents."""
    d = g.table("documents").select("doc_id", "text")
    n = g.table("supplier").agg(F.count("*").alias("n"))  # one row
    owned = d.crossJoin(F.broadcast(n)).select((F.col("doc_id") % (F.col("n") + 5)).alias("cik"), F.floor(F.col("doc_id") / (F.col("n") + 5)).alias("year"), "doc_id", "text")
    return owned.select("cik", F.concat(F.lit("T"), "cik").alias("ticker"), F.concat(F.lit("C"), "doc_id").alias("name"), F.when(F.col("year") > 0, F.col("year")).alias("year"), F.when(F.col("doc_id") % 3 != 0, F.col("text")).alias("business_description"), F.when(F.col("doc_id") % 3 != 1, F.col("text")).alias("risk_factors"))


def document_nodes(g: BusinessGraph) -> DataFrame:
    return loaders.document_nodes(retrieval.section_chunks(_filings(g)))


def chunk_nodes(g: BusinessGraph) -> DataFrame:
    c = loaders.chunk_nodes(retrieval.section_chunks(_filings(g)))
    return c.select("chunk_id", "doc_id", "chunk_index", "metadata", F.md5("text").alias("digest"))


def company_documents(g: BusinessGraph) -> DataFrame:
    return loaders.company_documents(document_nodes(g), g.company)


def merged_filings(g: BusinessGraph) -> DataFrame:
    """What a second run parsed, over what the first had."""
    k = F.col("cik")
    old = g.company.where("cik % 2 = 0").select("cik", F.lit("old").alias("business"), F.when(k % 4 == 0, "site.com").alias("website"))
    new = g.company.where("cik % 3 = 0").select("cik", F.when(k % 6 == 0, "new").alias("business"), F.lit("risk").alias("risk_factors"))
    return observations.upsert(old, new, ["cik"])


def pending_verdicts(g: BusinessGraph) -> DataFrame:
    c, v = F.col("confidence"), F.col("mentions") % 2 == 0
    return g.all_edges().select("rel_type", "src", "dst", relations.verdict_of(v, c).alias("verdict"), relations.verdict_key(F.concat(F.lit("said "), "mentions"), F.col("src").cast("string"), F.col("dst").cast("string"), F.col("rel_type")).alias("key"))




INGEST = {
    "src01_domain_rows": domain_rows,
    "src02_technology_rows": technology_rows,
    "src03_store_counts": lambda g: observations.store_counts(_status(g), _seen_technologies(g)),
    "src06_filing_paths": lambda g: observations.filing_paths(_paths(g)),
    "src07_newest_filings": lambda g: filings.newest_by_company(_paths(g)),
    "src09_filing_dates": filing_dates,
    "src10_latest_archives": latest_archives,
    "src11_archive_order": archive_order,
    "src13_known_companies": lambda g: landed.known_companies(g.table("customer").select((F.col("c_custkey") % 100).alias("cik"), F.when(F.col("c_custkey") % 2 == 0, "t").alias("ticker"), F.col("c_mktsegment").alias("name"))),
    "src14_registry_rows": registry_rows,
    "src15_market_rows": market_rows,
    "src16_source_answers": lambda g: observations.source_answers(_answers(g)),
    "src16_domain_votes": lambda g: observations.domain_votes(observations.source_answers(_answers(g))),
    "src17_annual_filers": annual_filers,
    "snk02_technology_nodes": technology_nodes,
    "snk02_uses_edges": uses_edges,
    "snk03_company_rows": company_rows,
    "snk04_has_domain_edges": has_domain_edges,
    "snk08_clean_rows": clean_rows,
    "snk09_similar_both_ways": similar_both_ways,
    "snk10_class_edges": class_edges,
    "snk11_deleted_edges": deleted_edges,
    "snk12_relation_edges": relation_edges,
    "snk13_document_nodes": document_nodes,
    "snk14_company_documents": company_documents,
    "snk17_merged_filings": merged_filings,
    "rag02_section_chunks": chunk_nodes,
    "ent42_verdicts": pending_verdicts,
}
