"""Answers of registries and markets, landed as JSON text; nothing is fetched here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import industry_code


def registry_info(landed: DataFrame, body: str = "body") -> DataFrame:
    """cik, sic, naics, name of submissions; a name may be a text or a list, whose first entry counts.

    A body that is no JSON gives no row.
    """
    said = landed.where(F.try_parse_json(F.col(body)).isNotNull()).select("cik", body)
    at = lambda path: F.get_json_object(body, path)
    naics = F.coalesce(at("$.naics"), at("$.naicsCode"))
    name = F.when(at("$.name").startswith("["), at("$.name[0]")).otherwise(at("$.name"))
    return said.select("cik", industry_code(at("$.sic"), 4).alias("sic"), industry_code(naics, 6).alias("naics"), F.nullif(F.trim(name), F.lit("")).alias("name"))


def market_info(landed: DataFrame, body: str = "body") -> DataFrame:
    """ticker and the market's fields; an answer without a price is none, an empty field is null."""
    fields = "currentPrice double, sector string, industry string, marketCap double, totalRevenue double, fullTimeEmployees long, country string"
    out = landed.select("ticker", F.from_json(body, fields).alias("m")).where("m.currentPrice IS NOT NULL")
    text = lambda c: F.nullif(F.trim(F.col(f"m.{c}")), F.lit("")).alias(c)
    return out.select(
        "ticker", F.col("m.currentPrice").alias("price"), text("sector"), text("industry"), text("country"),
        F.col("m.marketCap").alias("market_cap"), F.col("m.totalRevenue").alias("revenue"), F.col("m.fullTimeEmployees").alias("employees"),
    )


def known_companies(companies: DataFrame) -> DataFrame:
    """Distinct cik, ticker, name with blanks for what is missing, in order of cik."""
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return companies.where("cik IS NOT NULL").select("cik", blank("ticker"), blank("name")).distinct().orderBy("cik", "ticker", "name")
