"""Chunks, their vectors, and retrieval with the graph around a company."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.text import char_chunks, token_windows
from ..graph import undirected
from ..operators.ranking import keep_first, top_k
from ..operators.similarity import cosine

DECAY = 0.2
BATCH_TOKENS = 40_000


def document_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, chunk_index, chunk_id, text of every chunk of every document."""
    return docs.where(F.col(text).isNotNull()).select(F.col(key), F.posexplode(char_chunks(F.col(text))).alias("chunk_index", "text")).select(
        key, F.col("chunk_index").cast("long").alias("chunk_index"), F.concat_ws("_chunk_", F.col(key).cast("string"), F.col("chunk_index").cast("string")).alias("chunk_id"), "text"
    )


#: Sections of a filing and their labels.
SECTION_LABELS = {"business_description": "Item 1: Business", "risk_factors": "Item 1A: Risk Factors"}


def section_chunks(filings: DataFrame, sections: dict[str, str] | None = None) -> DataFrame:
    """cik, ticker, name, year, section, chunk_index, text, metadata of ``filings(cik, ticker, name, year, <section>...)``.

    Chunks are numbered from 0 in each section; ``sections`` maps columns to labels.
    """
    labels = sections or SECTION_LABELS
    parts = F.array(*(F.struct(F.lit(s).alias("section"), F.lit(label).alias("label"), F.col(s).alias("body")) for s, label in labels.items()))
    told = filings.select("cik", "ticker", "name", "year", F.explode(parts).alias("p")).where("p.body <> ''")
    out = told.select("cik", "ticker", "name", "year", "p.section", "p.label", F.posexplode(char_chunks(F.col("p.body"))).alias("chunk_index", "text"))
    return out.select("cik", "ticker", "name", "year", "section", F.col("chunk_index").cast("long").alias("chunk_index"), "text", F.to_json(F.create_map(F.lit("section"), "label")).alias("metadata"))


def documents_of(chunks: DataFrame, key: str = "doc_id") -> DataFrame:
    return chunks.groupBy(key).agg(F.count("*").alias("chunk_count"))


def next_chunk(chunks: DataFrame, key: str = "doc_id") -> DataFrame:
    """src, dst: each chunk and the one after it."""
    w = Window.partitionBy(key).orderBy("chunk_index")
    return chunks.select(F.col("chunk_id").alias("src"), F.lead("chunk_id").over(w).alias("dst")).where("dst IS NOT NULL")


def aggregated_embeddings(vectors: DataFrame, key: str, order: str, embedding: str = "embedding") -> DataFrame:
    """key, pos, average, weighted, maximum of the vectors of each key, component by component.

    Weights fall by exp(-0.2 i) with a vector's place among its key's and sum to 1.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    weighed = vectors.where(F.col(embedding).isNotNull()).withColumn("w", F.exp(-DECAY * place))
    flat = weighed.select(key, "w", F.posexplode(embedding).alias("pos", "x"))
    x = F.col("x").cast("double")
    return flat.groupBy(key, F.col("pos").cast("long").alias("pos")).agg(F.avg(x).alias("average"), (F.sum(x * F.col("w")) / F.sum("w")).alias("weighted"), F.max(x).alias("maximum"))


METHODS = {"average": "average", "weighted_average": "weighted", "max": "maximum"}


def combined_embeddings(vectors: DataFrame, key: str, order: str, method: str = "average", embedding: str = "embedding") -> DataFrame:
    """key, embedding: one vector for each key by ``method``; a key with a single vector keeps it.

    Vectors that are null (calls that failed) do not count; a key with none has a null vector.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}: one of {', '.join(METHODS)}")
    flat = aggregated_embeddings(vectors, key, order, embedding).select(key, "pos", F.col(METHODS[method]).alias("v"))
    whole = flat.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda x: x["v"]).alias("embedding"))
    return vectors.select(key).distinct().join(whole, key, "left")


def long_text_chunks(texts: DataFrame, key: str, text: str, size: int = 7000, overlap: int = 200) -> DataFrame:
    """key, part, piece: long texts in windows of about ``size`` tokens (words stand for tokens), to be embedded one by one."""
    windows = token_windows(F.split(F.trim(text), r"\s+"), size, overlap)
    return texts.where(F.trim(text) != "").select(key, F.posexplode(windows).alias("part", "w")).select(key, "part", F.array_join("w", " ").alias("piece"))


def search(vectors: DataFrame, query: DataFrame, limit: int = 10, least: float = 0.5, key: str = "vec_id") -> DataFrame:
    """key, score: the vectors nearest to the one row of ``query(q)``, exact over all."""
    scored = vectors.crossJoin(F.broadcast(query.limit(1))).select(key, F.round(cosine(F.col("embedding"), F.col("q")), 6).alias("score"))
    return top_k(scored.where(F.col("score") >= least), limit, F.desc("score"), F.asc(key))


def search_around(vectors: DataFrame, query: DataFrame, owner: DataFrame, edges: DataFrame, cik: int | None = None, limit: int = 10, least: float = 0.0) -> DataFrame:
    """As ``search``, over what a company and its neighbours on ``edges``, in either direction, own; over all without a company."""
    if cik is None:
        return search(vectors, query, limit, least)
    near = undirected(edges.select("src", "dst")).where(F.col("src") == cik).select(F.col("dst").alias("cik")).distinct()
    near = near.union(near.sparkSession.createDataFrame([(cik,)], "cik long")).distinct()
    mine = owner.join(near, "cik", "left_semi").select("vec_id").distinct()
    return search(vectors.join(mine, "vec_id", "left_semi"), query, limit, least)


def related_companies(start: DataFrame, edges: DataFrame, most_hops: int = 2, limit: int = 100) -> DataFrame:
    """source, node, relation, hops, via: companies within ``most_hops`` of ``start(node)``, nearest first.

    ``edges(src, dst, rel_type)`` are taken in both directions; a path's relation is that of its
    first edge, and of equal distances suppliers, customers, partners, competitors and then likeness
    come first.  Only the best path for each source, company, relation and first stop is carried
    on, so the rows of a round are bounded by those, however many paths there are.
    """
    rank = F.coalesce(F.create_map(*(F.lit(x) for kv in V.RELATION_PRIORITY.items() for x in kv))[F.col("relation")], F.lit(7))
    e = undirected(edges.select("src", "dst", "rel_type")).distinct()
    found = start.select(F.col("node").alias("source")).distinct().join(e, F.col("source") == F.col("src")).select("source", F.col("dst").alias("node"), F.col("rel_type").alias("relation"), F.lit(None).cast("long").alias("via")).distinct()
    out, step = found.withColumn("hops", F.lit(1)), found
    hop = e.select(F.col("src").alias("node"), F.col("dst").alias("next")).distinct()
    for n in range(2, most_hops + 1):
        # an edge is not gone back over at once; the second stop is what the path is known by
        step = step.join(hop, "node").where(F.col("next") != F.col("source")).select("source", F.col("next").alias("node"), "relation", F.coalesce("via", "node").alias("via")).distinct()
        out = out.unionByName(step.withColumn("hops", F.lit(n)))
    out = out.where("node <> source")
    return top_k(out, limit, F.asc("hops"), rank.asc(), F.asc("source"), F.asc("node"), F.asc("relation"), F.asc_nulls_first("via"))


RELATED_LEAST = 0.35


def answer_context(vectors: DataFrame, chunks: DataFrame, owner: DataFrame, query: DataFrame, edges: DataFrame, limit: int = 5, least: float = 0.5, most_hops: int = 2, related_least: float = RELATED_LEAST) -> DataFrame:
    """chunk_id, score, origin, hops, related_to, line: the best chunks to answer from.

    First the 2 * limit chunks nearest to the query, then, from companies related to those that own
    them, the 2 * limit nearest chunks with a score of at least ``related_least``, each with its
    owner's shortest relation; a chunk counts once, as found first; the best ``limit`` are told.
    """
    first = search(vectors, query, 2 * limit, least).select("vec_id", "score")
    start = owner.join(first, "vec_id", "left_semi").select(F.col("cik").alias("node")).distinct()
    related = related_companies(start, edges, most_hops)
    told = keep_first(related, ["node"], F.asc("hops"), F.asc("source"), F.asc("relation"), F.asc_nulls_first("via")).select(F.col("node").alias("cik"), "hops", F.col("source").alias("related_to"))
    theirs = owner.join(told.select("cik"), "cik", "left_semi").select("vec_id").distinct()
    more = search(vectors.join(theirs, "vec_id", "left_semi"), query, 2 * limit, related_least).select("vec_id", "score")
    every = first.select("vec_id", "score", F.lit("vector_search").alias("origin")).unionByName(more.join(first, "vec_id", "left_anti").select("vec_id", "score", F.lit("graph_traversal").alias("origin")))
    best = top_k(every, limit, F.desc("score"), F.asc("vec_id")).join(owner, "vec_id", "left")
    shown = F.col("origin") == "graph_traversal"
    out = best.join(told, "cik", "left").join(chunks.select(F.col("chunk_id").alias("vec_id"), "text"), "vec_id")
    line = F.concat(F.lit("["), "vec_id", F.lit("] "), F.col("text"))
    return out.select(F.col("vec_id").alias("chunk_id"), "score", "origin", F.when(shown, F.col("hops")).cast("long").alias("hops"), F.when(shown, F.col("related_to")).alias("related_to"), line.alias("line"))


def token_batches(docs: DataFrame, group: str, order: str, tokens: str, most: int = BATCH_TOKENS) -> DataFrame:
    """group, order, batch: consecutive rows of a group packed greedily, at most ``most`` tokens a batch.

    A group is streamed in order through one task that holds two numbers; a row that is larger
    than ``most`` is a batch of its own.
    """
    kinds = {c: docs.schema[c].dataType.simpleString() for c in (group, order)}

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, batch, held = None, 0, 0
        for b in batches:
            numbers = []
            for g, n in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                n = n or 0
                if g != current:
                    current, batch, held = g, 0, 0
                elif held + n > most:
                    batch, held = batch + 1, 0
                held += n
                numbers.append(batch)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(numbers, pa.int64())], [group, order, "batch"])

    ordered = docs.select(group, order, F.col(tokens).cast("long").alias(tokens)).repartition(group).sortWithinPartitions(group, order)
    return ordered.mapInArrow(fill, f"`{group}` {kinds[group]}, `{order}` {kinds[order]}, batch long")
