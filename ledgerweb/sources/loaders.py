"""Nodes and edges from parsed rows: companies, technologies, documents, relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..graph import blank_to_null
from ..operators.ranking import keep_first

FILING_URL = "https://www.sec.gov/Archives/edgar/data/"
MENTION_CHARS, CONTEXT_CHARS, DEFAULT_CONFIDENCE = 100, 500, 0.5


def technology_nodes(observed: DataFrame) -> DataFrame:
    """technology, category of ``observed(technology_name, technology_category)``: one row for each name, the first category by name."""
    named = blank_to_null(observed.select("technology_name", "technology_category")).where("technology_name IS NOT NULL")
    return named.groupBy(F.col("technology_name").alias("technology")).agg(F.min("technology_category").alias("category"))


def uses_edges(observed: DataFrame, domains: DataFrame, technologies: DataFrame) -> DataFrame:
    """Distinct domain, technology of ``observed(final_domain, technology_name)`` whose both ends are nodes."""
    e = observed.select(F.col("final_domain").alias("domain"), F.col("technology_name").alias("technology"))
    return e.join(domains.select("domain").distinct(), "domain", "left_semi").join(technologies.select("technology").distinct(), "technology", "left_semi").distinct().select("domain", "technology")


def filing_url(cik: Column, accession: Column) -> Column:
    """Where a filing is published: the cik without leading zeros, the accession number without dashes."""
    return F.concat(F.lit(FILING_URL), cik.cast("long").cast("string"), F.lit("/"), F.replace(accession, F.lit("-"), F.lit("")), F.lit("/"))


def company_rows(companies: DataFrame, parsed: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Rows of companies from ``companies(cik, ticker, name)`` and ``parsed(cik, business, risk_factors,
    accession, filed, fiscal_year_end)``, over the values that ``known`` has for them.

    Filing values fall back to what was known; blanks are absent; the year is that of the filing.
    """
    p = blank_to_null(parsed)
    rows = companies.select("cik", F.upper(F.trim("ticker")).alias("ticker"), F.trim("name").alias("name")).join(p, "cik", "left")
    filed, ended = F.to_date("filed"), F.to_date("fiscal_year_end")
    rows = rows.select(
        "cik", "ticker", "name", F.col("business").alias("description"), F.when(F.col("business").isNotNull(), "filing").alias("description_source"), "risk_factors",
        filed.alias("filing_date"), F.year(filed).alias("filing_year"), F.col("accession").alias("accession_number"), ended.alias("fiscal_year_end"),
        filing_url(F.col("cik"), F.col("accession")).alias("filing_url"),
    )
    rows = blank_to_null(rows)
    if known is None:
        return rows
    kept = ["filing_date", "filing_year", "accession_number", "fiscal_year_end", "filing_url"]
    old = known.select("cik", *(F.col(c).alias(f"__{c}") for c in kept))
    return rows.join(old, "cik", "left").select(*(F.coalesce(F.col(c), F.col(f"__{c}")).alias(c) if c in kept else F.col(c) for c in rows.columns))


def has_domain_edges(companies: DataFrame, domains: DataFrame) -> DataFrame:
    """Distinct src, dst where a company's ``domain`` is a domain's ``domain``; companies without one drop out."""
    return companies.select(F.col("cik").alias("src"), F.col("domain").alias("dst")).join(domains.select(F.col("domain").alias("dst")).distinct(), "dst", "left_semi").distinct().select("src", "dst")


def both_directions(pairs: DataFrame, kind: str, a: str = "a", b: str = "b") -> DataFrame:
    """src, dst, rel_type and the pairs' other columns: every pair as two edges, which replace all edges of ``kind``."""
    rest = [c for c in pairs.columns if c not in (a, b)]
    one = pairs.select(F.col(a).alias("src"), F.col(b).alias("dst"), F.lit(kind).alias("rel_type"), *rest)
    return one.unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "rel_type", *rest))


def rewritten(edges: DataFrame, new: DataFrame, kind: str) -> DataFrame:
    """``edges`` with those of ``kind`` replaced by ``new``."""
    return edges.where(F.col("rel_type") != kind).unionByName(new, allowMissingColumns=True)


def relation_edges(relations: DataFrame, companies: DataFrame) -> DataFrame:
    """One edge for each src, dst, rel_type whose both ends are companies; the last by confidence, mention and context wins.

    Mentions and contexts are cut, empty ones absent; a missing confidence is ``DEFAULT_CONFIDENCE``.
    """
    known = companies.select("cik").distinct()
    r = relations.join(known.withColumnRenamed("cik", "src"), "src", "left_semi").join(known.withColumnRenamed("cik", "dst"), "dst", "left_semi")
    text = lambda c, n: F.nullif(F.substring(c, 1, n), F.lit("")).alias(c)
    r = r.select("src", "dst", "rel_type", F.coalesce("confidence", F.lit(DEFAULT_CONFIDENCE)).alias("confidence"), text("raw_mention", MENTION_CHARS), text("context", CONTEXT_CHARS))
    return keep_first(r, ["src", "dst", "rel_type"], F.desc("confidence"), F.asc_nulls_last("raw_mention"), F.asc_nulls_last("context"))


def document_nodes(chunks: DataFrame) -> DataFrame:
    """doc_id, cik, section, year, ticker, name, chunk_count of ``chunks(cik, section, year, chunk_index, ...)``;
    ticker and name are those of the first chunk."""
    return chunks.groupBy("cik", "section", "year").agg(
        F.count("*").alias("chunk_count"), F.min_by("ticker", "chunk_index").alias("ticker"), F.min_by("name", "chunk_index").alias("name")
    ).select(document_id().alias("doc_id"), "cik", "section", "year", "ticker", "name", "chunk_count")


def document_id() -> Column:
    return F.concat_ws("_", F.col("cik").cast("string"), "section", F.coalesce(F.col("year").cast("string"), F.lit("unknown")))


def chunk_nodes(chunks: DataFrame) -> DataFrame:
    """``chunks`` with doc_id and chunk_id; the second is the edge from a chunk to its document, too."""
    doc = document_id()
    return chunks.select(F.concat_ws("_chunk_", doc, F.col("chunk_index").cast("string")).alias("chunk_id"), doc.alias("doc_id"), "chunk_index", "text", "metadata")


def company_documents(documents: DataFrame, companies: DataFrame) -> DataFrame:
    """src (company), dst (document) of the documents whose company is known."""
    return documents.join(companies.select("cik").distinct(), "cik", "left_semi").select(F.col("cik").alias("src"), F.col("doc_id").alias("dst"))
