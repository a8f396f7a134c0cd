"""Upserts and readers of observation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import root_domain, valid_domain
from ..operators.ranking import keep_first


def latest_values(rows: DataFrame, key: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """One row for each key: of every column its last value that is not null."""
    at = F.struct(*order)
    return rows.groupBy(*key).agg(*(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns))


def upsert(current: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``current`` with the values of ``new`` that are not null on top; new keys are added."""
    columns = [c for c in current.columns if c not in key]
    columns += [c for c in new.columns if c not in key + columns]
    both = current.alias("o").join(new.alias("n"), key, "full_outer")
    value = lambda c: F.coalesce(*(F.col(f"{s}.{c}") for s, df in (("n", new), ("o", current)) if c in df.columns)).alias(c)
    return both.select(*key, *(value(c) for c in columns))


def update(current: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``current`` with the values of ``new`` that are not null on top; rows of ``new`` without a match are left out."""
    return upsert(current, new.join(current.select(*key), key, "left_semi"), key)


def delete_where(rows: DataFrame, gone: Column) -> tuple[DataFrame, int]:
    """What is left, and how many rows went; a condition that is null keeps its row."""
    go = F.coalesce(gone, F.lit(False))
    return rows.where(~go), rows.where(go).count()


def fill_only(current: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``current`` with values of ``new`` only where it has none; no rows are added."""
    shared = [c for c in new.columns if c not in key]
    renamed = new.select(*key, *(F.col(c).alias(f"__{c}") for c in shared))
    out = current.join(renamed, key, "left")
    return out.select(*(F.coalesce(F.col(c), F.col(f"__{c}")).alias(c) if c in shared else F.col(c) for c in current.columns))


def with_filings(companies: DataFrame, filers: DataFrame, known_bad: DataFrame, key: str) -> DataFrame:
    """Companies that file and are not known not to; an empty list of filers passes all."""
    kept = companies if filers.isEmpty() else companies.join(filers.select(key), key, "left_semi")
    return kept.join(known_bad.select(key), key, "left_anti")


def company_directory(rows: DataFrame, order: str) -> DataFrame:
    """cik in ten digits, upper-case ticker, trimmed name; the first row of each cik wins."""
    out = rows.select(F.lpad(F.col("cik").cast("string"), 10, "0").alias("cik"), F.upper("ticker").alias("ticker"), F.trim("name").alias("name"), order)
    return keep_first(out, ["cik"], F.asc(order)).drop(order)


def merged_properties(sec: Column, market: Column, other: Column, sec_wins: bool) -> Column:
    """A property of several sources: the market's unless the registry overrides; the rest fills gaps."""
    return F.coalesce(sec, market, other) if sec_wins else F.coalesce(market, sec, other)


def observed_domains(status: DataFrame, whois: DataFrame) -> DataFrame:
    """Distinct observations of a domain with its registration, if any; without a domain none."""
    def iso(ms: str) -> Column:
        return F.when(F.col(ms) > 0, F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ssXXX"))

    out = status.where("final_domain IS NOT NULL").join(whois.drop("id").withColumnRenamed("url_status_id", "id"), "id", "left").drop("id").distinct()
    copies = {"initial_domain": "domain", "http_status": "status", "http_status_text": "status_description", "response_time_seconds": "response_time"}
    return out.select("*", *(F.col(c).alias(n) for c, n in copies.items() if c in out.columns), iso("observed_at_ms").alias("timestamp"), iso("creation_date_ms").alias("creation_date"), iso("expiration_date_ms").alias("expiration_date"))


def observed_technologies(status: DataFrame, technologies: DataFrame) -> DataFrame:
    t = technologies.where("technology_name IS NOT NULL AND technology_name <> ''")
    return status.select(F.col("id").alias("url_status_id"), "final_domain").join(t.select("url_status_id", "technology_name", "technology_category"), "url_status_id").drop("url_status_id").distinct()


def conditional_counts(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Distinct keys, and distinct keys with a value that is not blank, in one pass."""
    blank = lambda c: F.coalesce(F.trim(F.col(c).cast("string")) == "", F.lit(True))
    return rows.agg(F.count_distinct(key).alias("total"), *(F.count_distinct(F.when(~blank(c), F.col(key))).alias(f"with_{c}") for c in columns))


def store_counts(status: DataFrame, technologies: DataFrame) -> DataFrame:
    """One row: distinct final domains, distinct technology names, and rows with a technology (not distinct)."""
    named = technologies.where("technology_name IS NOT NULL AND technology_name <> ''")
    t = named.agg(F.count_distinct("technology_name").alias("technologies"), F.count("*").alias("uses"))
    return status.agg(F.count_distinct("final_domain").alias("domains")).crossJoin(t)  # one row each


def filing_paths(files: DataFrame, limit: int | None = None) -> DataFrame:
    """path of .html and .xml files in order, from a ``binaryFile`` or path table."""
    out = files.where(F.col("path").rlike(r"\.(html?|xml)$")).select("path").orderBy("path")
    return out.limit(limit) if limit else out


def has_annual_report(forms: Column, dates: Column, start: str, end: str) -> Column:
    """Whether any filing of two parallel arrays is a 10-K within the dates; True where they could not be read."""
    return F.coalesce(F.exists(F.arrays_zip(forms.alias("f"), dates.alias("d")), lambda x: (x["f"] == "10-K") & x["d"].between(start, end)), F.lit(True))


#: How sure the answer of each source is.
SOURCE_CONFIDENCE = {"yfinance": 0.9, "sec_edgar": 0.85, "sec_edgar_text": 0.75, "finviz": 0.7, "finnhub": 0.6}
#: Domains that belong to registries and services and to no company.
INFRASTRUCTURE = ["sec.gov", "xbrl.org", "fasb.org", "w3.org", "google.com", "yahoo.com", "finviz.com", "finnhub.io"]


def source_answers(urls: DataFrame) -> DataFrame:
    """cik, domain, source, confidence of every source's ``urls(cik, source, url)``: the registrable domain;
    a miss, an invalid one and one of infrastructure is null with confidence 0."""
    d = root_domain(F.col("url"))
    good = F.when(valid_domain(d) & ~d.isin(*INFRASTRUCTURE), d)
    sure = F.coalesce(F.create_map(*(F.lit(x) for kv in SOURCE_CONFIDENCE.items() for x in kv))[F.col("source")], F.lit(0.0))
    out = urls.select("cik", good.alias("domain"), "source", sure.alias("confidence"))
    return out.withColumn("confidence", F.when(F.col("domain").isNull(), 0.0).otherwise(F.col("confidence")))


def domain_votes(votes: DataFrame) -> DataFrame:
    """cik, domain, source, confidence: of all sources' answers the surest; a miss is no answer."""
    return keep_first(votes.where("domain IS NOT NULL"), ["cik"], F.desc("confidence"), F.asc("source"), F.asc("domain")).select("cik", "domain", "source", "confidence")
