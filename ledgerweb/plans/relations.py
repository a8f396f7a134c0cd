"""From filings to typed relations: sentences, candidates, companies, verdicts, tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import resolution as R
from ..functions import text as T
from ..functions.sections import parse_pages
from ..sources.filings import filing_metadata

KEYWORDS = {
    "HAS_COMPETITOR": V.COMPETITOR_KEYWORDS,
    "HAS_CUSTOMER": V.CUSTOMER_KEYWORDS,
    "HAS_SUPPLIER": V.SUPPLIER_KEYWORDS,
    "HAS_PARTNER": V.PARTNER_KEYWORDS,
}
#: Characters of a mention and of its context that an edge keeps.
MENTION_CHARS, CONTEXT_CHARS = 100, 500
#: Texts under this many characters get no vector.
EMBED_CHARS = 200


def parsed_filings(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """key, business, risk_factors, website, accession, filed, fiscal_year_end of each filing.

    Each page is parsed once; a field that is not found is null.
    """
    meta = filing_metadata(pages.select(key, html), html)
    kept = ["accession", "filed", "fiscal_year_end"]
    return parse_pages(meta, key, html, keep=kept).select(key, "business", "risk_factors", "website", *kept)


def extracted_relations(filings: DataFrame, companies: DataFrame) -> DataFrame:
    """src, dst, rel_type, raw_mention, context, confidence: the first mention of each company in
    each filing and relation, business text before risk text.

    ``filings`` has cik, business, risk_factors; ``companies`` cik, ticker, name.
    """
    lookup = R.company_lookup(companies)
    texts = filings.select(F.col("cik").alias("src"), F.posexplode(F.array("business", "risk_factors")).alias("part", "text")).where("text IS NOT NULL")
    every = None
    for relation, keywords in KEYWORDS.items():
        one = T.relationship_sentences(texts, keywords).select("src", F.lit(relation).alias("rel_type"), (F.col("part") * 1_000_000 + F.col("place")).alias("spot"), "sentence")
        every = one if every is None else every.unionByName(one)
    found = T.candidates(every, "sentence").withColumn("place", F.col("spot") * 1000 + F.col("place"))
    out = R.resolve_mentions(found, lookup, ["src", "rel_type"], own="src")
    return out.select(
        "src", F.col("cik").alias("dst"), "rel_type", F.substring("candidate", 1, MENTION_CHARS).alias("raw_mention"),
        F.substring("sentence", 1, CONTEXT_CHARS).alias("context"), "confidence",
    )


def decided_relations(relations: DataFrame, similarities: DataFrame, verdicts: DataFrame | None = None) -> DataFrame:
    """Relations with their decision: by rules, patterns and similarity, and for suppliers and
    customers by a table of verdicts (src, dst, rel_type, verdict) where there is no similarity."""
    key = ["src", "dst", "rel_type"]
    r = relations.join(similarities.select("src", "dst", F.col("similarity").alias("embedding_similarity")), ["src", "dst"], "left")
    r = r.join(verdicts, key, "left") if verdicts is not None else r.withColumn("verdict", F.lit(None).cast("string"))
    d = R.tiered_decision(F.col("raw_mention"), F.col("context"), F.col("rel_type"), F.col("dst").cast("string"), F.col("embedding_similarity"), F.col("verdict"))
    return r.withColumn("d", d).select("*", "d.decision", F.col("d.tier").alias("decided_by")).drop("d")


def verdict_key(context: Column, src: Column, dst: Column, relation: Column) -> Column:
    """What a verdict is stored under."""
    return F.substring(F.sha2(F.concat_ws("|", F.substring(context, 1, CONTEXT_CHARS), src, dst, relation), 256), 1, 16)


def verdict_of(verified: Column, confidence: Column) -> Column:
    return F.when(verified & (confidence >= 0.7), "confirmed").when(~verified & (confidence >= 0.7), "rejected").otherwise("uncertain")


def verification_cost(claims: DataFrame, price_in: float, price_out: float) -> DataFrame:
    """claims, tokens_in, tokens_out, cost of asking about every claim; prices are per million."""
    tokens_in = F.sum(200 + T.token_estimate(F.col("context")))
    return claims.agg(F.count("*").alias("claims"), F.coalesce(tokens_in, F.lit(0)).alias("tokens_in"), (F.count("*") * 100).alias("tokens_out")).withColumn(
        "cost", (F.col("tokens_in") * price_in + F.col("tokens_out") * price_out) / 1e6
    )


def mention_text(mention: Column, context: Column, hint: Column | None = None, most: int = 300) -> Column:
    """``mention (hint) : context``, the context cut at its last full stop past the half."""
    cut_ = F.substring(context, 1, most)
    stop = F.length(cut_) - F.locate(".", F.reverse(cut_)) + 1
    short = F.when((F.length(context) > most) & F.reverse(cut_).contains(".") & (stop > most / 2), F.substring(cut_, F.lit(1), stop)).otherwise(cut_)
    named = mention if hint is None else F.concat(mention, F.coalesce(F.concat(F.lit(" ("), hint, F.lit(")")), F.lit("")))
    return F.concat_ws(" : ", named, F.nullif(short, F.lit("")))


def embedding_worklist(nodes: DataFrame, done: DataFrame, key: str, text: str, model: str | None = None, dim: int | None = None, direct: int = 8000) -> DataFrame:
    """Nodes whose text is long enough and has no vector yet: key, text, digest, whole (whether it is short enough for one call).

    Vectors are known by their text's hash, so an edited text gets a new one; with ``model`` and
    ``dim`` only vectors of ``done(digest, model, dim)`` that match both count.
    """
    if model is not None:
        done = done.where((F.col("model") == model) & (F.col("dim") == dim))
    work = nodes.where(F.length(text) >= EMBED_CHARS).select(key, text, T.text_hash(F.col(text)).alias("digest"), (T.token_estimate(F.col(text)) <= direct).alias("whole"))
    return work.join(done.select("digest").distinct(), "digest", "left_anti")
