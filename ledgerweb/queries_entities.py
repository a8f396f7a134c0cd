"""Registered queries of entity resolution, vectors and retrieval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions import resolution, text
from .graph import BusinessGraph
from .operators import similarity
from .plans import competitors, relations, retrieval

#: Sentences that say one thing or another of a company.
SAID = [
    "We compete with {m} in most markets.",
    "Our principal competitors include {m} and others.",
    "{m} is not a direct competitor of ours.",
    "We purchase parts from {m} every year.",
    "Raw materials are provided by {m}.",
    "Our suppliers include {m}.",
    "We sell most of our products to {m}.",
    "Our customers include {m} and its partners.",
    "We partner with {m} on research.",
    "A joint venture and strategic alliance with {m} began.",
    "Mr. Smith serves as a director of {m}.",
    "Our shares are listed on the NASDAQ: {m}.",
    "{m} is a wholly owned subsidiary of the parent company.",
    "Apps are distributed through app stores operated by {m}.",
    "The matter of Doe v. {m} was settled.",
    "We met {m} last spring. It was warm. Nobody else came along that day, and so the talk went on for hours and hours.",
    "He was formerly at {m}.",
    "Competition from {m}, a supplier and customer, is strong. Partners agree.",
    "They speak of the {m} of things.",
    "Firms such as {m}, and we, grow.",
]
#: Ways to write a company.
FORMS = ["{n}", "T{k}", "IT", "Apple", "nvidia", "{l} corp."]


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def claims(g: BusinessGraph) -> DataFrame:
    """Every relation with a mention of its company and a sentence that holds it."""
    e = g.all_edges().select("rel_type", "src", "dst", "mentions", "embedding_similarity").join(g.company.select(F.col("cik").alias("dst"), "name"), "dst")
    m = _pick(FORMS, F.col("src") + F.col("dst"))
    for mark, value in (("{n}", F.col("name")), ("{k}", F.col("dst").cast("string")), ("{l}", F.lower("name"))):
        m = F.replace(m, F.lit(mark), value)
    e = e.withColumn("mention", m)
    said = F.replace(_pick(SAID, F.col("src") * 7 + F.col("dst") * 3 + F.col("mentions")), F.lit("{m}"), F.col("mention"))
    return e.withColumn("sentence", said)


def verdicts(g: BusinessGraph) -> DataFrame:
    v = resolution.verified_relation(F.col("rel_type"), F.col("sentence"), F.col("mention"))
    return claims(g).select("rel_type", "src", "dst", v["result"].alias("result"), F.coalesce(v["suggested"], F.lit("")).alias("suggested"), v["confidence"].alias("confidence"))


EVERY_FILTER = (*resolution.DEFAULT_FILTERS[:3], "negation", *resolution.DEFAULT_FILTERS[3:])


def filter_reasons(g: BusinessGraph) -> DataFrame:
    reason = resolution.filter_reason(F.col("mention"), F.col("sentence"), EVERY_FILTER)
    return claims(g).select("rel_type", "src", "dst", F.coalesce(reason, F.lit("")).alias("reason"))


def filter_counts(g: BusinessGraph) -> DataFrame:
    return resolution.filter_counts(claims(g).select(F.col("mention").alias("candidate"), "sentence"))


def self_references(g: BusinessGraph) -> DataFrame:
    own = g.company.select(F.col("cik").alias("src"), F.col("name").alias("own"), F.col("ticker").alias("own_ticker"))
    hit = resolution.self_reference(F.when(F.col("src") % 2 == 0, F.concat(F.lit("The "), "own")).otherwise(F.col("mention")), F.col("own"), F.concat(F.lit("T"), "dst"))
    return claims(g).join(own, "src").select("rel_type", "src", "dst", hit.alias("itself"))


def resolved_mentions(g: BusinessGraph) -> DataFrame:
    """Who every sentence mentions, with its confidence."""
    said = claims(g).select("rel_type", "src", "dst", F.lit(0).alias("rank"), F.lit(0).alias("place"), F.col("mention").alias("candidate"), "sentence")
    out = resolution.resolve_mentions(said, resolution.company_lookup(g.company), ["rel_type", "src", "dst"], own="src")
    return out.select("rel_type", "src", "dst", "cik", "match_type", F.round("confidence", 6).alias("confidence"))


def tiered(g: BusinessGraph) -> DataFrame:
    similar = claims(g).where("(src + dst) % 4 <> 0").groupBy("src", "dst").agg(F.max("embedding_similarity").alias("similarity"))
    told = claims(g).where("src % 2 = 0").select("src", "dst", "rel_type", F.when(F.col("dst") % 3 == 0, "confirmed").when(F.col("dst") % 3 == 1, "uncertain").otherwise("rejected").alias("verdict"))
    r = claims(g).select("rel_type", "src", "dst", F.col("mention").alias("raw_mention"), F.col("sentence").alias("context"))
    return relations.decided_relations(r, similar, told).select("rel_type", "src", "dst", "decision", F.col("decided_by").cast("long").alias("decided_by"))


def mention_texts(g: BusinessGraph) -> DataFrame:
    shown = relations.mention_text(F.col("mention"), F.col("sentence"), F.when(F.col("src") % 2 == 0, F.col("rel_type")), 60)
    return claims(g).select("rel_type", "src", "dst", shown.alias("shown"))


def combined(g: BusinessGraph) -> DataFrame:
    s, tier = resolution.combined_confidence((F.col("src") % 11) / 10, F.col("embedding_similarity"), F.col("dst") % 7 == 0, F.col("dst") % 5 == 0)
    return g.all_edges().select("rel_type", "src", "dst", F.round(s, 9).alias("score"), tier.alias("tier"))


def verification_costs(g: BusinessGraph) -> DataFrame:
    out = relations.verification_cost(claims(g).select(F.col("sentence").alias("context")), 0.15, 0.6)
    return out.withColumn("cost", F.round("cost", 9))


NAMES = ["{n} Inc.", "Société {s} Générale", "{s} & Sons Holdings, LLC", "The {n} Group", "  {s}-{k} Corp", "3M {s} Company", "AT&T {s}", "...", "{s}"]


def names(g: BusinessGraph) -> DataFrame:
    """Company names of many forms, with a mention of each."""
    k = F.col("c_custkey")
    n = _pick(NAMES, k)
    for mark, value in (("{n}", F.col("c_name")), ("{s}", F.initcap(F.lower("c_mktsegment"))), ("{k}", k.cast("string"))):
        n = F.replace(n, F.lit(mark), value)
    said = F.when(k % 3 == 0, F.upper(n)).when(k % 3 == 1, F.substring(n, 1, 9)).otherwise(F.concat(n, F.lit(" Corp")))
    return g.table("customer").select(k.alias("id"), n.alias("name"), said.alias("mention"))


def folded_names(g: BusinessGraph) -> DataFrame:
    n = F.col("name")
    return names(g).select("id", text.folded_name(n).alias("folded"), text.folded_name(n, False).alias("whole"), text.lookup_name(n).alias("looked_up"))


def _spread(df: DataFrame) -> DataFrame:
    """Over a fixed number of tasks: a small file is one task otherwise, however long each of its rows takes."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def ngram_sets(g: BusinessGraph) -> DataFrame:
    return _spread(names(g)).select("id", F.array_join(F.array_sort(text.char_ngrams(F.col("name"))), " ").alias("grams"))


def character_scores(g: BusinessGraph) -> DataFrame:
    m, n = F.col("mention"), F.col("name")
    score = F.round(text.ngram_similarity(text.char_ngrams(m), text.char_ngrams(n)), 9)
    out = _spread(names(g)).withColumn("score", score)
    return out.select("id", "score", resolution.score_label(F.col("score"), "character").alias("label"), resolution.name_match(m, n).alias("same"), resolution.prefix_match(m, n).alias("begins"), resolution.ticker_match(m, F.lower(n)).alias("ticker"))


def ranked_names(g: BusinessGraph) -> DataFrame:
    few = names(g).where("id % 10 = 3").select("mention").where("mention <> '...'")
    companies = names(g).where("id % 7 = 1").select(F.col("id").alias("cik"), "name")
    return resolution.ranked_by_characters(few, companies, 3).select("mention", "cik", F.round("score", 9).alias("score"))


def _vectors(g: BusinessGraph) -> DataFrame:
    return g.table("embeddings").select("vec_id", "embedding")


def semantic_scores(g: BusinessGraph) -> DataFrame:
    mentions = _vectors(g).select(F.col("vec_id").alias("mention"), (F.col("vec_id") % 130).alias("cik"), F.when(F.col("vec_id") % 17 != 0, F.col("embedding")).alias("embedding"))
    known = _vectors(g).where("vec_id < 120").select(F.col("vec_id").alias("cik"), F.when(F.col("vec_id") % 13 != 0, F.col("embedding")).alias("embedding"))
    out = resolution.semantic_scores(mentions, known).withColumn("score", F.round("score", 6))
    return out.withColumn("label", resolution.score_label(F.col("score"), "semantic"))


def context_similarities(g: BusinessGraph) -> DataFrame:
    contexts = _vectors(g).select("vec_id", (F.col("vec_id") % 150).cast("string").alias("ticker"), "embedding")
    known = _vectors(g).where("vec_id < 120").select(F.col("vec_id").cast("string").alias("ticker"), "embedding")
    return resolution.context_similarity(contexts, known).withColumn("similarity", F.round("similarity", 6)).select("vec_id", "similarity", (F.col("similarity") >= 0.3).alias("passed"))


def decision_costs(g: BusinessGraph) -> DataFrame:
    out = resolution.decision_costs(tiered(g).select(F.col("decided_by").alias("tier")))
    return out.withColumns({c: F.round(c, 9) for c in ("cost", "per_decision")})


def candidate_companies(g: BusinessGraph) -> DataFrame:
    said = claims(g).select("rel_type", "src", "dst", F.col("mention").alias("candidate"))
    return competitors.resolve_candidates(said, competitors.spellings(g.company)).select("rel_type", "src", "dst", "cik", "confidence")


def _lettered(c: Column) -> Column:
    """A number in letters, as names have them."""
    return F.translate(c.cast("string"), "0123456789", "abcdefghij")


def told_competitors(g: BusinessGraph) -> DataFrame:
    """Filings that name every competitor in one of three ways, and who is found in them."""
    firm = F.concat(F.lit("Firm"), _lettered(F.col("cik")))
    companies = g.company.select("cik", F.concat(F.lit("QX"), F.upper(_lettered(F.col("cik")))).alias("ticker"), F.concat(firm, F.lit(" Holdings Corporation")).alias("name"))
    e = g.edges("HAS_COMPETITOR").select("src", F.col("dst").alias("cik")).join(companies, "cik")
    way = F.when(F.col("cik") % 3 == 0, F.concat(F.lit("We compete with "), "name", F.lit(" in many markets. "))).when(F.col("cik") % 3 == 1, F.concat(F.lit("Our principal competitor is "), firm, F.lit(" and a few others. "))).otherwise(F.concat(F.lit("Competitors such as "), "ticker", F.lit(" are strong. ")))
    told = e.groupBy("src").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cik", way.alias("w")))), lambda x: x["w"]), "").alias("told"))
    filings = told.select(F.col("src").alias("cik"), F.when(F.col("src") % 2 == 0, F.col("told")).alias("business"), F.when(F.col("src") % 2 == 1, F.col("told")).alias("risk_factors"))
    return competitors.competitors(filings, companies).select("src", "dst", "confidence")


def partial_names(g: BusinessGraph) -> DataFrame:
    """What beginnings of names mean: all of a name, all but its last letter, its first word, and a text longer than it."""
    lookup = competitors.spellings(names(g).select(F.col("id").alias("cik"), F.concat(F.lit("X"), "id").alias("ticker"), "name"))
    asked = names(g).select(F.explode(F.array(F.lower("name"), F.expr("substring(lower(name), 1, length(name) - 1)"), F.split(F.lower("name"), " ")[0], F.concat(F.lower("name"), F.lit(" of america")))).alias("query")).where("length(query) >= 3").distinct()
    return asked.join(competitors.partial_names(lookup), "query").select("query", "cik", F.round("confidence", 9).alias("confidence"))


def fuzzy_names(g: BusinessGraph) -> DataFrame:
    """Names of seven words, one or two of them changed, against the names."""
    words = ["acme", "blue", "corp", "delta", "east", "first", "global", "inc"]
    part = g.table("part").select("p_partkey", F.concat_ws(" ", *(_pick([f"{w}{i}" for i in range(7)], F.floor(F.floor(F.col("p_partkey") / 2) % 300 / (j + 1))) for j, w in enumerate(words))).alias("name"))
    companies = part.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("cik"), F.lit(None).cast("string").alias("ticker"), "name")
    asked = part.where("p_partkey % 2 = 1").select(F.concat("name", F.lit(" more")).alias("candidate")).distinct()
    out = resolution.match_candidates(asked, resolution.company_lookup(companies), fuzzy=True)
    return out.select("candidate", "cik", "match_type", F.round("match_confidence", 9).alias("confidence"))


def sentences_around(g: BusinessGraph) -> DataFrame:
    at = F.col("doc_id") * 37 % F.greatest(F.length("text"), F.lit(1))
    return g.table("documents").where("text IS NOT NULL").select("doc_id", F.md5(text.containing_sentence(F.col("text"), at.cast("int"))).alias("sentence"))


def token_windows(g: BusinessGraph) -> DataFrame:
    words = F.filter(F.split(F.col("text"), r"[\s]+"), lambda w: w != "")
    d = g.table("documents").where("text IS NOT NULL").select("doc_id", F.posexplode(text.token_windows(words, 300, 50)).alias("part", "w"))
    return d.where(F.size("w") > 0).select("doc_id", F.col("part").cast("long").alias("part"), F.size("w").cast("long").alias("n"), F.md5(F.array_join("w", " ")).alias("digest"))


def truncated(g: BusinessGraph) -> DataFrame:
    return g.table("documents").select("doc_id", F.md5(text.truncate_tokens(F.col("text"), 100)).alias("digest"))


def long_text_vectors(g: BusinessGraph) -> DataFrame:
    """One vector for each label out of those of its parts, of which some failed."""
    v = g.table("embeddings").select("label", "vec_id", F.when(F.col("vec_id") % 3 != 0, F.col("embedding")).alias("embedding"))
    out = retrieval.combined_embeddings(v, "label", "vec_id", "weighted_average")
    return out.select("label", F.posexplode_outer("embedding").alias("pos", "v")).select("label", F.col("pos").cast("long").alias("pos"), F.round("v", 6).alias("v"))


def token_batches(g: BusinessGraph) -> DataFrame:
    docs = g.table("documents").select("source", "doc_id", text.token_estimate(F.col("text")).alias("tokens"))
    return retrieval.token_batches(docs, "source", "doc_id", "tokens")


def valid_vectors(g: BusinessGraph) -> DataFrame:
    k, e = F.col("vec_id"), F.col("embedding").cast("array<double>")
    odd = F.when(k % 5 == 0, F.transform(e, lambda x, i: F.when(i == 1, float("nan")).otherwise(x))).when(k % 5 == 1, F.slice(e, 1, 3)).when(k % 5 == 2, F.transform(e, lambda x: x * 0)).when(k % 25 == 3, F.lit(None))
    return g.table("embeddings").select(k, similarity.valid_embedding(F.when(k % 5 < 4, odd).otherwise(e), 64).alias("valid"), similarity.valid_score(F.when(k % 3 == 0, F.lit(float("nan"))).otherwise(k / 100 - 1)).alias("score"))


def domain_pairs(g: BusinessGraph) -> DataFrame:
    """Domains with alike vectors, one direction."""
    v = _vectors(g).where("vec_id > 0")
    return similarity.similar_nodes(v, 0.3, 3, key="vec_id").select("key1", "key2", similarity.rounded("score").alias("score"))


def keyword_pairs(g: BusinessGraph) -> DataFrame:
    v = _vectors(g).join(g.table("documents").select(F.col("doc_id").alias("vec_id"), "text"), "vec_id")
    return similarity.similar_nodes(v, 0.3, 3, "text", 1500, "vec_id").select("key1", "key2", similarity.rounded("score").alias("score"))


def _owner(g: BusinessGraph) -> DataFrame:
    n = g.table("supplier").agg(F.count("*").alias("n"))  # one row
    return _vectors(g).select("vec_id").crossJoin(F.broadcast(n)).select("vec_id", (F.col("vec_id") % F.col("n")).alias("cik"))


def _asked(g: BusinessGraph) -> DataFrame:
    return _vectors(g).where("vec_id = 3").select(F.col("embedding").alias("q"))


def _traversed(g: BusinessGraph) -> DataFrame:
    return g.all_edges().select("src", "dst", "rel_type")


def graph_search(g: BusinessGraph) -> DataFrame:
    from .plans.catalogue import description_pairs

    alike = description_pairs(g).select(F.col("key1").alias("src"), F.col("key2").alias("dst"))
    e = g.all_edges("HAS_COMPETITOR", "HAS_PARTNER").select("src", "dst").unionByName(alike)
    return retrieval.search_around(_vectors(g), _asked(g), _owner(g), e, 7)


def related(g: BusinessGraph) -> DataFrame:
    start = g.company.where("cik IN (7, 9)").select(F.col("cik").alias("node"))
    return retrieval.related_companies(start, _traversed(g)).withColumn("hops", F.col("hops").cast("long"))


def answer_context(g: BusinessGraph) -> DataFrame:
    chunk = g.table("documents").select(F.col("doc_id").alias("chunk_id"), "text")
    # the vectors are unlike each other, so a lower score than usual counts as related
    out = retrieval.answer_context(_vectors(g), chunk, _owner(g), _asked(g), _traversed(g), 12, related_least=0.15)
    return out.withColumn("line", F.md5("line"))


ENTITIES = {
    "ent06_sentences_around": sentences_around,
    "ent16_self_references": self_references,
    "ent17_filter_reasons": filter_reasons,
    "ent18_filter_counts": filter_counts,
    "ent20_folded_names": folded_names,
    "ent22_ngram_sets": ngram_sets,
    "ent23_ranked_names": ranked_names,
    "ent24_character_scores": character_scores,
    "ent29_resolved_mentions": resolved_mentions,
    "ent30_mention_texts": mention_texts,
    "ent31_semantic_scores": semantic_scores,
    "ent32_combined": combined,
    "ent33_context_similarities": context_similarities,
    "ent34_verdicts": verdicts,
    "ent35_tiered_decisions": tiered,
    "ent36_decision_costs": decision_costs,
    "ent38_candidate_companies": candidate_companies,
    "ent40_told_competitors": told_competitors,
    "ent43_verification_costs": verification_costs,
    "joi20_partial_names": partial_names,
    "joi21_fuzzy_names": fuzzy_names,
    "emb01_token_windows": token_windows,
    "emb04_long_text_vectors": long_text_vectors,
    "emb06_truncated": truncated,
    "emb07_token_batches": token_batches,
    "sim01_valid_vectors": valid_vectors,
    "sim08_domain_pairs": domain_pairs,
    "sim09_keyword_pairs": keyword_pairs,
    "rag05_search_around": graph_search,
    "rag06_answer_context": answer_context,
    "joi16_related_companies": related,
}
