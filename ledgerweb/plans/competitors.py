"""Competitors that filings name: contexts, names, and the companies that they mean."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.text import candidates, lookup_name, relationship_sentences
from ..operators.ranking import keep_first

LEAST_PARTIAL, CONTEXT_CHARS, BLOCK_CHARS = 3, 200, 200
SIMPLE_KEYWORDS = ["competitor", "compete", "competing", "competition", "competitive", "rival"]


def _all(text: Column, pattern: str, group: int, flags: str = "") -> Column:
    return F.regexp_extract_all(text, F.lit(f"{flags}{pattern}"), group)


def _stretches(text: Column, number: int, pattern: str) -> Column:
    """pattern, nth, whole, held of every context that one pattern finds."""
    found = F.arrays_zip(_all(text, pattern, 0, "(?is)").alias("whole"), _all(text, pattern, 1, "(?is)").alias("held"))
    return F.transform(found, lambda m, i: F.struct(F.lit(number).alias("pattern"), i.alias("nth"), m["whole"].alias("whole"), m["held"].alias("held")))


def _named(text: Column, number: int, pattern: str) -> Column:
    """form, at, candidate of every name that one pattern finds."""
    return F.transform(_all(text, pattern, 1), lambda c, i: F.struct(F.lit(number).alias("form"), i.alias("at"), F.trim(c).alias("candidate")))


def competitor_mentions(filings: DataFrame, common: list[str] = V.NAME_BLOCKLIST) -> DataFrame:
    """src, place, candidate, context of ``filings(cik, business, risk_factors)``: every name in a context
    of competition, the first of each spelling.

    ``common`` are words that are no names.  Stretches of more than ``BLOCK_CHARS`` characters are
    first searched for lists that begin with "such as".
    """
    text = filings.select(F.col("cik").alias("src"), F.posexplode(F.array("business", "risk_factors")).alias("part", "text")).where("text <> ''")
    stretches = F.flatten(F.array(*(_stretches(F.col("text"), k, p) for k, p in enumerate(V.COMPETITOR_CONTEXTS))))
    met = text.select("src", "part", F.explode(stretches).alias("m"))
    pieces = F.concat(F.when(F.length("m.held") > BLOCK_CHARS, _all(F.col("m.held"), V.SUCH_AS, 1, "(?i)")).otherwise(F.array().cast("array<string>")), F.array("m.held"))
    met = met.select("src", "part", "m.pattern", "m.nth", F.substring("m.whole", 1, CONTEXT_CHARS).alias("context"), F.posexplode(pieces).alias("piece", "held"))
    names = F.flatten(F.array(*(_named(F.col("held"), k, p) for k, p in enumerate(V.COMPANY_NAMES))))
    found = met.select("*", F.explode(names).alias("n")).select("src", F.struct("part", "pattern", "nth", "piece", "n.form", "n.at").alias("place"), "n.candidate", "context")
    low = F.lower("candidate")
    found = found.where(F.length("candidate").between(2, 50) & ~low.isin(common))
    return keep_first(found.withColumn("low", low), ["src", "low"], F.asc("place")).drop("low")


def spellings(companies: DataFrame) -> DataFrame:
    """kind, key, cik, ticker, name: tickers in capitals, and names as they are and as they are looked up.

    Of companies with one spelling the one with the largest cik has it.
    """
    def keyed(kind: str, key: Column) -> DataFrame:
        return companies.select(F.lit(kind).alias("kind"), key.alias("key"), "cik", "ticker", "name").where("key <> ''")

    every = keyed("ticker", F.upper(F.trim("ticker"))).unionByName(keyed("name", F.lower(F.trim("name")))).unionByName(keyed("name", lookup_name(F.col("name"))))
    return keep_first(every, ["kind", "key"], F.desc("cik"))


def partial_names(lookup: DataFrame, least: float = 0.8) -> DataFrame:
    """query, cik, ticker, name, confidence: for every beginning of a name that is sure enough the best company.

    The whole name is 1, a beginning that ends with a word .95, a longer share than .6 counts .85
    times that share; it has to be more than ``least``.  Names are unfolded into those beginnings,
    so whoever asks joins on equality and a common first word makes no pairs.
    """
    n = F.length("key")
    sure = lambda k: F.when(k == n, 1.0).when(F.substring("key", k + 1, F.lit(1)) == " ", 0.95).when(k / n > 0.6, 0.85 * k / n).otherwise(0.0)
    cuts = F.filter(F.transform(F.sequence(F.lit(LEAST_PARTIAL), n), lambda k: F.struct(k.alias("k"), sure(k).alias("confidence"))), lambda x: x["confidence"] > least)
    named = lookup.where((F.col("kind") == "name") & (n >= LEAST_PARTIAL))
    each = named.select("key", "cik", "ticker", "name", F.explode(cuts).alias("c")).select(F.substring("key", F.lit(1), F.col("c.k")).alias("query"), "key", "cik", "ticker", "name", "c.confidence")
    return keep_first(each, ["query"], F.desc("confidence"), F.asc("key"), F.asc("cik")).drop("key")


def _tried(mentions: DataFrame, lookup: DataFrame, sure: float, own: str) -> DataFrame:
    """Every mention with each company that its ticker, name or looked-up name means, but for itself."""
    c = F.col("candidate")
    tries = [(0, "ticker", F.upper(F.trim(c)), 1.0), (1, "name", F.lower(F.trim(c)), 1.0), (2, "name", lookup_name(c), sure)]
    keys = F.array(*(F.struct(F.lit(i).alias("rank"), F.lit(kind).alias("kind"), key.alias("key"), F.lit(s).alias("confidence")) for i, kind, key, s in tries))
    names = mentions.columns
    asked = mentions.withColumn("__k", F.explode(keys)).select(*names, F.col("__k.rank").alias("__rank"), F.col("__k.kind").alias("kind"), F.col("__k.key").alias("key"), F.col("__k.confidence").alias("confidence"))
    return asked.join(lookup, ["kind", "key"]).where(F.col("cik") != F.col(own))


def resolve_competitors(mentions: DataFrame, lookup: DataFrame, least: float = 0.8, own: str = "src") -> DataFrame:
    """``mentions`` with cik, ticker, name, confidence: ticker and name 1, looked-up name .9, else the best beginning of a name.

    A company is no competitor of itself: what means itself is tried by the next way.
    """
    names, cols = mentions.columns, ["cik", "ticker", "name", "confidence"]
    whole = _tried(mentions, lookup, 0.9, own).select(*names, "__rank", *cols)
    asked = mentions.withColumn("query", lookup_name(F.col("candidate"))).where(F.length("query") >= LEAST_PARTIAL)
    part = asked.join(partial_names(lookup, least), "query").where(F.col("cik") != F.col(own)).select(*names, F.lit(3).alias("__rank"), *cols)
    return keep_first(whole.unionByName(part), names, F.asc("__rank")).drop("__rank")


def competitors(filings: DataFrame, companies: DataFrame, least: float = 0.8) -> DataFrame:
    """src, dst, name, confidence, raw_mention, context: the first mention of each competitor."""
    found = resolve_competitors(competitor_mentions(filings), spellings(companies), least)
    one = keep_first(found, ["src", "cik"], F.asc("place"))
    return one.select("src", F.col("cik").alias("dst"), "name", "confidence", F.col("candidate").alias("raw_mention"), "context")


def high_value(name: Column) -> Column:
    low = F.lower(F.trim(name))
    return reduce(lambda a, b: a | b, (low.contains(h) for h in V.HIGH_VALUE_NAMES), F.lit(False))


def resolve_candidates(mentions: DataFrame, lookup: DataFrame, own: str = "src", sure: float = 0.95) -> DataFrame:
    """``mentions`` with cik, ticker, name, confidence: blocked words mean no company, and a short word only one of high value.

    The first way by which a mention means a company decides: if that is too short a match, later
    ways are not tried.
    """
    low, names = F.lower(F.trim("candidate")), mentions.columns
    known = low.isin(V.HIGH_VALUE_NAMES)
    asked = mentions.where(~F.upper(F.trim("candidate")).isin(V.TICKER_BLOCKLIST) & (~low.isin(V.NAME_BLOCKLIST) | known))
    first = keep_first(_tried(asked, lookup, sure, own), names, F.asc("__rank"))
    short = F.when(F.col("__rank") < 2, F.length("candidate") <= 4).otherwise(F.length("key") <= 4)
    return first.where(~short | known | high_value(F.col("name"))).select(*names, "cik", "ticker", "name", "confidence")


def simple_competitors(filings: DataFrame, companies: DataFrame) -> DataFrame:
    """src, dst, confidence, raw_mention, context: names in sentences that speak of competition, looked up and never guessed."""
    texts = filings.select(F.col("cik").alias("src"), F.posexplode(F.array("business", "risk_factors")).alias("part", "text")).where("text <> ''")
    said = relationship_sentences(texts, SIMPLE_KEYWORDS).select("src", "part", F.col("place").alias("nth"), "sentence")
    found = candidates(said, "sentence").select("src", F.struct("part", "nth", "rank", "place").alias("place"), "candidate", "sentence")
    low = F.lower(F.trim("candidate"))
    asked = found.where(~F.upper(F.trim("candidate")).isin(V.TICKER_BLOCKLIST) & ~low.isin(V.NAME_BLOCKLIST))
    best = keep_first(_tried(asked, spellings(companies), 0.95, "src"), ["src", "place", "candidate"], F.asc("__rank"))
    one = keep_first(best, ["src", "cik"], F.asc("place"))
    return one.select("src", F.col("cik").alias("dst"), "confidence", F.col("candidate").alias("raw_mention"), F.substring("sentence", 1, CONTEXT_CHARS).alias("context"))
