"""Registered queries over the graph."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import resolution, text
from .graph import BusinessGraph, duplicate_keys, undirected
from .operators import algorithms, paths, ranking, similarity
from .plans import adoption, analytics, catalogue, relations, retrieval
from .sources import observations


def _on_graph(f: Callable[[BusinessGraph], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: f(BusinessGraph(spark, sf_dir))


def breakdown(g: BusinessGraph) -> DataFrame:
    """A row for each relation of two companies, beside the technologies that they share."""
    rows = catalogue.similarity_breakdown(g).select(F.explode("direct_relationships").alias("r"), F.array_join("shared_technologies", ",").alias("shared_technologies"), "shared_tech_count")
    return rows.select("r.rel_type", "r.score", "r.method", "shared_tech_count", "shared_technologies")


CATALOGUE = {
    "qry01_market_leaders": catalogue.market_leaders,
    "qry02_threat_ratio": catalogue.threat_ratio,
    "qry03_mutual_rivals": catalogue.mutual_rivals,
    "qry04_aspiring_disruptors": catalogue.aspiring_disruptors,
    "qry05_shared_competitors": catalogue.shared_competitors,
    "qry06_competitors_with_evidence": catalogue.competitors_with_evidence,
    "qry07_competitors_of_competitors": catalogue.competitors_of_competitors,
    "qry08_similar_descriptions": lambda g: catalogue.description_pairs(g).withColumn("score", similarity.rounded("score")),
    "qry09_explainable_similarity": catalogue.explainable_similarity,
    "qry10_multi_dimensional_similarity": catalogue.multi_dimensional_similarity,
    "qry11_key_suppliers": catalogue.key_suppliers,
    "qry12_verified_suppliers": catalogue.verified_edges,
    "qry13_verified_customers": lambda g: catalogue.verified_edges(g, "HAS_CUSTOMER"),
    "qry14_technologies_of_company": catalogue.technologies_of,
    "qry16_cited_sample": catalogue.cited_sample,
    "qry17_landscape": catalogue.landscape,
    "qry18_supply_chain": catalogue.supply_chain,
    "qry19_next_technologies": catalogue.next_technologies,
    "qry20_industry_leaders": catalogue.industry_leaders,
    "qry22_adopters_per_technology": catalogue.adopters_per_technology,
    "qry23_suppliers_two_hops": catalogue.suppliers_two_hops,
    "qry24_exposure": catalogue.exposure,
    "qry25_dependants": catalogue.dependants,
    "qry26_companies_using": catalogue.companies_using,
    "qry27_similar_suppliers": catalogue.similar_suppliers,
    "qry29_count_summary": catalogue.count_summary,
    "qry31_relation_evidence": catalogue.relation_evidence,
    "qry32_edge_presence": catalogue.edge_presence,
    "qry33_coverage": catalogue.coverage,
    "sim17_similar_companies": catalogue.similar_companies,
    "sim18_extended_similar": catalogue.extended_similar,
    "sim20_similarity_breakdown": breakdown,
}


def _nodes(g: BusinessGraph) -> DataFrame:
    return g.company.select(F.col("cik").alias("node"))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def likely_adopters(g: BusinessGraph) -> DataFrame:
    one = g.technology.where("technology = 'Brand#1/ECONOMY'").select("technology")
    return adoption.adoption(g.uses, one, top_k=10).select("domain", "score")


def typed_paths(g: BusinessGraph) -> DataFrame:
    e = g.all_edges("HAS_COMPETITOR", "HAS_SUPPLIER").select("src", "dst", "rel_type")
    out = paths.typed_paths(_nodes(g).where("node = 7"), undirected(e), 2)
    return out.groupBy("node", F.col("hops").cast("long").alias("hops"), F.array_join("types", ">").alias("types")).agg(F.count("*").alias("paths"))


def technology_pairs(g: BusinessGraph) -> DataFrame:
    both = similarity.best_by_jaccard(g.company_uses, "cik", "technology", 0.1, 5)
    return both.groupBy(F.least("src", "dst").alias("cik1"), F.greatest("src", "dst").alias("cik2")).agg(F.round(F.max("score"), 6).alias("score"))


def via_domains(g: BusinessGraph) -> DataFrame:
    return _rounded(similarity.via_alike_sets(g.has_domain, g.uses, "domain", "technology", 0.6), "score")


def candidate_review(g: BusinessGraph) -> DataFrame:
    out = resolution.split_edges(g.all_edges()).where("confidence_tier = 'medium'")
    return ranking.top_k(out.select("rel_type", "src", "dst", "embedding_similarity"), 25, F.desc("embedding_similarity"), F.asc("rel_type"), F.asc("src"), F.asc("dst"))


def cleanup_counts(g: BusinessGraph) -> DataFrame:
    e = g.all_edges()
    return e.groupBy("rel_type", resolution.cleanup_action(F.col("rel_type"), F.col("embedding_similarity")).alias("action")).agg(F.count("*").alias("n"))


def tiers(g: BusinessGraph) -> DataFrame:
    return g.all_edges().select("rel_type", "src", "dst", resolution.confidence_tier(F.col("rel_type"), F.col("embedding_similarity")).alias("tier"))


def latest_observations(g: BusinessGraph) -> DataFrame:
    e = g.table("events").select("user_id", "ts", "event_id", F.when(F.col("event_type") == "click", F.col("value")).alias("click"), F.when(F.col("event_type") == "error", F.col("value")).alias("error"), F.from_json("props", "k long")["k"].alias("k"))
    return observations.latest_values(e, ["user_id"], ["ts", "event_id"], ["click", "error", "k"])


def filled_companies(g: BusinessGraph) -> DataFrame:
    least = g.company.groupBy("sic").agg(F.min("revenue").alias("r"))
    new = g.company.join(least, "sic").select("cik", F.col("r").alias("revenue"))
    return observations.fill_only(g.company.select("cik", "revenue"), new, ["cik"])


def upserted_companies(g: BusinessGraph) -> DataFrame:
    new = g.table("customer").select(F.col("c_custkey").alias("cik"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("revenue"), F.col("c_mktsegment").alias("segment"))
    return observations.update(g.company.select("cik", "revenue"), new, ["cik"])


def merged_companies(g: BusinessGraph) -> DataFrame:
    m = g.table("customer").select(F.col("c_custkey").alias("cik"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("m"))
    both = g.company.select("cik", F.when(F.col("cik") % 3 == 0, F.col("employees").cast("double")).alias("s")).join(m, "cik", "left")
    none = F.lit(None).cast("double")
    source = F.concat_ws(",", F.when(F.col("s").isNotNull(), "SEC"), F.when(F.col("m").isNotNull(), "MARKET"))
    return both.select("cik", observations.merged_properties(F.col("s"), F.col("m"), none, True).alias("registry_first"), observations.merged_properties(F.col("s"), F.col("m"), none, False).alias("market_first"), source.alias("data_source"))


def directory(g: BusinessGraph) -> DataFrame:
    rows = g.table("customer").select((F.col("c_custkey") % 700).alias("cik"), F.concat(F.lit("t"), "c_custkey").alias("ticker"), F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("name"), F.col("c_custkey").alias("row"))
    return observations.company_directory(rows, "row")


def filers(g: BusinessGraph) -> DataFrame:
    e, bad = g.edges("HAS_COMPETITOR"), g.edges("HAS_SUPPLIER").where("mentions > 1")
    return observations.with_filings(g.company.select("cik", "name"), e.select(F.col("src").alias("cik")), bad.select(F.col("src").alias("cik")), "cik")


def observation_counts(g: BusinessGraph) -> DataFrame:
    e = g.table("events").select("user_id", F.when(F.col("value") > 10, F.col("value")).alias("value"), F.when(F.col("event_type") != "click", F.col("event_type")).alias("kind"))
    return observations.conditional_counts(e, "user_id", ["value", "kind"])


def keyword_sentences(g: BusinessGraph) -> DataFrame:
    out = text.relationship_sentences(g.table("documents").select("doc_id", "text"), ["thehe", "lyou", "queci"])
    return out.select("doc_id", F.col("place").cast("long").alias("place"), F.md5("sentence").alias("sentence"))


def chunks(g: BusinessGraph) -> DataFrame:
    return retrieval.document_chunks(g.table("documents"))


def chunk_digests(g: BusinessGraph) -> DataFrame:
    return chunks(g).select("chunk_id", "chunk_index", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("digest"))


def _query_vector(g: BusinessGraph) -> DataFrame:
    return g.table("embeddings").where("vec_id = 3").select(F.col("embedding").alias("q"))


def vector_search(g: BusinessGraph) -> DataFrame:
    return retrieval.search(g.table("embeddings"), _query_vector(g), 10, 0.2)


def label_embeddings(g: BusinessGraph) -> DataFrame:
    return _rounded(retrieval.aggregated_embeddings(g.table("embeddings"), "label", "vec_id"), "average", "weighted", "maximum")


def worklist(g: BusinessGraph) -> DataFrame:
    done = g.table("documents").where("source = 'src1'").select(text.text_hash(F.col("text")).alias("digest"))
    return relations.embedding_worklist(g.table("documents"), done, "doc_id", "text", direct=300).select("doc_id", "digest", "whole")


def page_domains(g: BusinessGraph) -> DataFrame:
    url = F.col("url")
    return g.table("pages").select("page_id", text.host(url).alias("host"), text.root_domain(url).alias("domain"))


def _found(g: BusinessGraph, quoted: bool) -> DataFrame:
    docs = g.table("documents").select("doc_id", F.concat(F.lit('"The Firm" and '), "text").alias("text"))
    return text.candidates(docs, quoted=quoted).select("doc_id", F.col("rank").cast("long").alias("rank"), F.col("place").cast("long").alias("place"), "candidate", "pattern")


def industry_codes(g: BusinessGraph) -> DataFrame:
    k = F.col("c_custkey")
    code = F.when(k % 3 == 0, F.concat(F.lit("SIC "), k % 20)).when(k % 3 == 1, (k * 7).cast("string")).otherwise("n/a")
    return g.table("customer").select(k.alias("id"), text.industry_code(code, 4).alias("sic"), text.industry_code(code, 6).alias("naics"))


OPERATORS = {
    "gra01_pagerank": lambda g: _rounded(algorithms.pagerank(_nodes(g), g.edges("HAS_COMPETITOR")), "rank"),
    "gra02_communities": lambda g: algorithms.communities(_nodes(g), g.edges("HAS_COMPETITOR")),
    "gra03_degrees": lambda g: algorithms.degrees(g.edges("HAS_COMPETITOR"), _nodes(g)),
    "gra04_betweenness": lambda g: _rounded(algorithms.betweenness(_nodes(g), g.edges("HAS_COMPETITOR")), "betweenness"),
    "gra06_adoption": lambda g: adoption.adoption(g.uses),
    "gra05_measures": lambda g: _rounded(analytics.competition_measures(_nodes(g), g.edges("HAS_COMPETITOR"), False), "rank", "betweenness"),
    "joi16_typed_paths": typed_paths,
    "sim07_risk_pairs": lambda g: catalogue.risk_pairs(g).withColumn("score", similarity.rounded("score")),
    "sim10_industry_pairs": lambda g: similarity.same_class_pairs(g.company, ["sic", "sector"]),
    "sim13_size_pairs": lambda g: similarity.size_pairs(g.company).select("a", "b", "method", F.col("bucket").cast("long").alias("bucket")),
    "sim14_technology_pairs": technology_pairs,
    "sim15_affinity": lambda g: _rounded(adoption.affinity(g.uses), "score"),
    "sim16_via_domains": via_domains,
    "qry15_co_occurrence": lambda g: ranking.top_k(_rounded(adoption.affinity(g.uses).where("score > 0.3"), "score"), 20, F.desc("score"), F.asc("src"), F.asc("dst")),
    "qry21_likely_adopters": likely_adopters,
    "qry28_next_chunk": lambda g: retrieval.next_chunk(chunks(g)),
    "qry30_candidate_review": candidate_review,
    "snk01_latest_observations": latest_observations,
    "snk05_filled_companies": filled_companies,
    "snk06_upserted_companies": upserted_companies,
    "snk07_merged_companies": merged_companies,
    "snk13_documents": lambda g: retrieval.documents_of(chunks(g)),
    "snk15_duplicate_keys": lambda g: duplicate_keys(g.table("lineitem"), "l_orderkey", "l_linenumber"),
    "snk16_cleanup_counts": cleanup_counts,
    "src05_observation_counts": observation_counts,
    "src12_directory": directory,
    "src18_filers": filers,
    "ent01_sentences": keyword_sentences,
    "ent03_candidates": lambda g: _found(g, False),
    "ent05_quoted_candidates": lambda g: _found(g, True),
    "txt10_industry_codes": industry_codes,
    "ent37_tiers": tiers,
    "rag01_chunks": chunk_digests,
    "rag03_page_text": lambda g: text.html_text(g.table("pages"), "page_id"),
    "rag04_search": vector_search,
    "emb02_aggregated": label_embeddings,
    "emb06_token_counts": lambda g: g.table("documents").groupBy("source").agg(F.sum(text.token_estimate(F.col("text"))).alias("tokens")),
    "emb08_text_hash": lambda g: g.table("documents").select("doc_id", text.text_hash(F.col("text")).alias("digest")),
    "emb05_worklist": worklist,
    "txt01_parsed_pages": lambda g: relations.parsed_filings(g.table("pages"), "page_id"),
    "txt08_domains": page_domains,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import queries_entities, queries_ingest

    return {k: _on_graph(f) for k, f in (CATALOGUE | OPERATORS | queries_ingest.INGEST | queries_entities.ENTITIES).items()}
