"""Which technologies go together, and who is likely to adopt which."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import dataset
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.algorithms import pagerank
from ..operators.ranking import numbered, top_k_per_group
from ..operators.similarity import rounded, set_jaccard_pairs, top_k_of_either_side
from ..session import cut

#: Ranks, and products of rows with targets, that a task holds at once.
RANKS_AT_ONCE = 2_000_000


def co_occurrence(uses: DataFrame) -> DataFrame:
    """src, dst, weight: technologies used by one domain, and how many such domains."""
    x, y = uses.select("domain", F.col("technology").alias("src")), uses.select("domain", F.col("technology").alias("dst"))
    return x.join(y, "domain").where("src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))


def affinity(uses: DataFrame, cutoff: float = 0.1, top_k: int = 50) -> DataFrame:
    """src, dst, score: Jaccard of the technologies that two technologies occur with."""
    pairs = set_jaccard_pairs(co_occurrence(uses).select("src", "dst"), "src", "dst")
    return top_k_of_either_side(pairs, cutoff, top_k)


def _whole_groups(batches: Iterator[pa.RecordBatch], key: str, least: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by ``key`` in tables of some ``least`` rows that tear no key apart, and where each key starts."""
    held = None
    for batch in batches:
        held = pa.concat_tables([held, pa.Table.from_batches([batch])]) if held else pa.Table.from_batches([batch])
        if held.num_rows >= least:
            held = held.combine_chunks()
            starts = _starts(held, key)
            if starts[-1]:
                yield held.slice(0, starts[-1]), starts[:-1]
                held = held.slice(starts[-1])
    if held is not None and held.num_rows:
        held = held.combine_chunks()
        yield held, _starts(held, key)


def _starts(rows: pa.Table, key: str) -> np.ndarray:
    at = rows.column(key).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    return np.flatnonzero(np.append(True, at[1:] != at[:-1]))


def likeliest(uses: DataFrame, ranks: DataFrame, technologies: int, targets: int, top_k: int) -> DataFrame:
    """source, domain, score: of ``ranks(source, technology, rank)`` each source's ``top_k`` domains that do not use it.

    A domain's score is the best rank of its technologies, times 1 + ln(their number + 1), to 6 digits;
    ties go to the smaller domain.  Ranks are written in blocks of sources of some ``RANKS_AT_ONCE``.
    A task reads a block from the shared folder and its domains in order, and keeps each source's
    best: what is shuffled is a row for each use and ``top_k`` for each task and source, never a row
    for each domain and source.
    """
    named, kind = (uses.schema[c].dataType.simpleString() for c in ("technology", "domain"))
    blocks = max(1, -(-technologies * targets // RANKS_AT_ONCE))
    rows = uses.where("technology IS NOT NULL").select("domain", "technology").repartition("domain").sortWithinPartitions("domain")

    def best_of(uri: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = pafs.FileSystem.from_uri(uri)
        table = dataset.dataset(path, filesystem=store, format="parquet").to_table()
        if not table.num_rows:
            return
        names, sources = (table.column(c).combine_chunks().unique() for c in ("technology", "source"))
        rank = np.zeros((len(names), len(sources)))
        rank[pc.index_in(table.column("technology"), names).to_numpy(), pc.index_in(table.column("source"), sources).to_numpy()] = table.column("rank").to_numpy()
        own = pc.fill_null(pc.index_in(names, sources), -1).to_numpy(zero_copy_only=False)  # a technology's place among the sources
        j, s, at, domains, before = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), None, 0
        bound = np.full(len(sources), -np.inf)
        for part, starts in _whole_groups(batches, "domain", max(1, RANKS_AT_ONCE // len(sources))):
            t = pc.index_in(part.column("technology").combine_chunks(), names).to_numpy()
            n = np.diff(np.append(starts, len(t)))
            factor = np.array([1 + math.log(x + 1) for x in range(n.max() + 1)])
            score = np.floor(np.maximum.reduceat(rank[t], starts) * factor[n][:, None] * 1e6 + 0.5) / 1e6
            taken = (own[t] >= 0) & part.column("domain").is_valid().to_numpy()
            score[np.repeat(np.arange(len(n)), n)[taken], own[t][taken]] = -np.inf
            # domains come in order, so one that only equals a full list's last loses
            x, y = np.nonzero(score > bound)
            if len(x):
                found = part.column("domain").combine_chunks().take(pa.array(starts[x]))
                domains = pa.concat_arrays([domains, found]) if domains is not None else found
                j, s, at = np.concatenate([j, y]), np.concatenate([s, score[x, y]]), np.concatenate([at, before + x])
                order = np.lexsort((at, -s, j))
                place = np.arange(len(j)) - np.searchsorted(j[order], j[order], side="left")
                order = order[place < top_k]
                j, s, at, domains = j[order], s[order], at[order], domains.take(pa.array(order))
                full = np.flatnonzero(np.bincount(j, minlength=len(sources)) == top_k)
                bound[full] = s[np.searchsorted(j, full, side="right") - 1]
            before += len(n)
        if len(j):
            yield from pa.Table.from_arrays([sources.take(pa.array(j)), domains, pa.array(s)], names=["source", "domain", "score"]).to_batches(max_chunksize=10_000)

    out = None
    for block in range(blocks):
        uri = cut(ranks.where(F.pmod(F.xxhash64("source"), F.lit(blocks)) == block), "ranks")._cut_path
        part = rows.mapInArrow(lambda batches, uri=uri: best_of(uri, batches), f"source {named}, domain {kind}, score double")
        out = part if out is None else out.unionByName(part)
    return top_k_per_group(out, ["source"], top_k, F.desc("score"), F.asc("domain"))


def adoption(uses: DataFrame, targets: DataFrame | None = None, top_k: int = 50, most_share: float = 0.5, batch: bool = False) -> DataFrame:
    """domain, technology, score: the likeliest adopters of every target technology.

    Targets are the technologies that at most half of all domains use, or those of ``targets``
    among them.  Personalised PageRank runs from each target by itself, all in one job; with
    ``batch`` from all of them together.  A domain's score is the best rank of its technologies,
    times 1 + ln(their number + 1); domains that use the target have none.
    """
    uses = cut(uses, "uses")
    domains = uses.select("domain").distinct().count()
    used = cut(uses.groupBy("technology").agg(F.count("*").alias("n")), "technologies")
    nodes = used.select(F.col("technology").alias("node"))
    rare = used.where(F.col("n") <= most_share * domains).select("technology")
    if targets is not None:
        rare = rare.join(targets, "technology", "left_semi")
    source = F.lit("all") if batch else F.col("technology")
    together = cut(co_occurrence(uses), "together")
    ranks = pagerank(nodes, together, sources=rare.select(source.alias("source"), F.col("technology").alias("node")))
    ranks = ranks.select("source", F.col("node").alias("technology"), "rank")
    if not batch:
        return likeliest(uses, ranks, used.count(), rare.count(), top_k).select("domain", F.col("source").alias("technology"), "score")
    held = uses.join(cut(ranks, "ranks"), "technology").groupBy("domain").agg(F.max("rank").alias("best"), F.count("*").alias("n"))
    scored = held.select("domain", rounded(F.col("best") * (1 + F.log(F.col("n") + 1))).alias("score"))
    # one ranking for all targets: the first top_k that do not own a target are among its first top_k + owners
    places = numbered(scored, "place", F.desc("score"), F.asc("domain"))
    owned = uses.select("domain", F.col("technology").alias("source"))
    owners = owned.join(rare.withColumnRenamed("technology", "source"), "source", "left_semi").groupBy("source").agg(F.count("*").alias("owners"))
    asked = owners.select("source", F.explode(F.sequence(F.lit(1).cast("long"), F.col("owners") + top_k)).alias("place"))
    scored = asked.join(places.withColumn("place", F.col("place").cast("long")), "place").select("source", "domain", "score")
    open_ = scored.join(owned, ["domain", "source"], "left_anti")
    return top_k_per_group(open_, ["source"], top_k, F.desc("score"), F.asc("domain")).select("domain", F.col("source").alias("technology"), "score")
