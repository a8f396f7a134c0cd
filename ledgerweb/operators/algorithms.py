"""Graph algorithms as loops of joins and aggregates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, release

#: Iterations between two cuts of the lineage.
CUT_EVERY = 5
#: Edges that betweenness may hold in one worker; beyond, it raises.
MOST_ADJACENCY = 5_000_000


def degrees(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, in_degree, out_degree; a node without edges on a side has null there."""
    into = edges.groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("in_degree"))
    out = edges.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("out_degree"))
    return nodes.select("node").join(into, "node", "left").join(out, "node", "left")


def pagerank(nodes: DataFrame, edges: DataFrame, iterations: int = 20, damping: float = 0.85, sources: DataFrame | None = None) -> DataFrame:
    """node, rank after a fixed number of rounds of (1 - d) + d * sum(weight / out weight * rank).

    Ranks start at 1 - d; nodes without edges keep it; nothing is redistributed from nodes
    without outgoing edges.  ``edges`` may carry a weight.  With ``sources(source, node)`` the
    restart goes only to a source's nodes, for all sources in one job, and the result has
    source, node, rank.

    An edge of weight 0 from each node to itself keeps every node in the one join of a round.
    """
    e = edges if "weight" in edges.columns else edges.withColumn("weight", F.lit(1.0))
    total = e.groupBy("src").agg(F.sum("weight").alias("total"))
    share = e.join(total, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("share"))
    share = cut(share.unionByName(nodes.select(F.col("node").alias("src"), F.col("node").alias("dst"), F.lit(0.0).alias("share"))), "shares")
    if sources is None:
        ranks = nodes.select(F.lit(0).alias("source"), "node", F.lit(1 - damping).alias("restart"))
    else:
        own = sources.select("source", "node", F.lit(1 - damping).alias("restart"))
        every = sources.select("source").distinct().crossJoin(nodes.select("node"))  # a state row for each source and node
        ranks = every.join(own, ["source", "node"], "left").withColumn("restart", F.coalesce("restart", F.lit(0.0)))
    restart = cut(ranks, "restart")
    ranks = restart.withColumn("rank", F.col("restart"))
    for i in range(iterations):
        got = ranks.join(share, F.col("node") == F.col("src")).groupBy("source", F.col("dst").alias("node")).agg(F.sum(F.col("rank") * F.col("share")).alias("got"))
        if sources is None:
            ranks = got.select("source", "node", (F.lit(1 - damping) + damping * F.col("got")).alias("rank"))
        else:
            ranks = got.join(restart, ["source", "node"]).select("source", "node", (F.col("restart") + damping * F.col("got")).alias("rank"))
        if i % CUT_EVERY == CUT_EVERY - 1:
            ranks = cut(ranks, "ranks")
    return ranks.select("node", "rank") if sources is None else ranks.select("source", "node", "rank")


def _search(source: int, start: np.ndarray, to: np.ndarray, state: tuple[np.ndarray, ...]) -> None:
    """Adds to ``score`` what hangs on every node that ``source`` reaches, level by level.

    ``to[start[v] : start[v + 1]]`` are the nodes after v.  What is touched is put back, so a search
    costs what it reaches, whatever the size of the graph.
    """
    seen, paths, owed, place, score = state
    seen[source], paths[source] = True, 1.0
    front, levels = np.array([source]), []
    while True:
        n = start[front + 1] - start[front]
        s = np.repeat(front, n)
        d = to[np.arange(len(s)) + np.repeat(start[front] - (np.cumsum(n) - n), n)]
        new = ~seen[d]
        s, d = s[new], d[new]
        if not len(d):
            break
        np.add.at(paths, d, paths[s])
        at = np.arange(len(d))
        place[d] = at
        front = d[place[d] == at]  # each once
        seen[front] = True
        levels.append((s, d, front))
    for s, d, _ in reversed(levels):
        np.add.at(owed, s, paths[s] / paths[d] * (1 + owed[d]))
    for _, _, nodes in levels:
        score[nodes] += owed[nodes]
        seen[nodes], paths[nodes], owed[nodes] = False, 0.0, 0.0
    seen[source], paths[source], owed[source] = False, 0.0, 0.0


def betweenness(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, betweenness: exact, directed, unweighted.

    Sources are dealt over the tasks, and each task holds the adjacency, 12 bytes an edge, as long as
    that has at most ``MOST_ADJACENCY`` edges; larger graphs are searched by joins, level by level.
    Every source is searched, so the time grows with nodes times edges that they reach.
    """
    e = cut(edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct(), "ways")
    if e.count() > MOST_ADJACENCY:
        return _betweenness_by_joins(nodes, e)
    table = e.toArrow()
    src, dst = (table.column(c).to_numpy() for c in ("src", "dst"))
    ids = np.unique(np.concatenate([src, dst]))
    order = np.argsort(src, kind="stable")
    start = np.searchsorted(src[order], np.append(ids, ids[-1:] + 1))
    known = nodes.sparkSession.sparkContext.broadcast((ids, start, np.searchsorted(ids, dst[order]).astype(np.int32)))

    def brandes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, start, to = known.value
        state = (np.zeros(len(ids), bool), *(np.zeros(len(ids), t) for t in (float, float, np.int64, float)))
        for batch in batches:
            asked = batch["node"].to_numpy()
            asked = np.searchsorted(ids, asked[np.isin(asked, ids)])
            for source in asked:
                _search(source, start, to, state)
        score = state[-1]
        hit = np.flatnonzero(score)
        yield pd.DataFrame({"node": ids[hit].astype("int64"), "part": score[hit]})

    # a number of its own, or adaptive execution makes one task of a few thousand ids
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = nodes.select("node").where("node IS NOT NULL").repartition(tasks, "node").mapInPandas(brandes, "node long, part double")
    return nodes.select("node").join(parts.groupBy("node").agg(F.sum("part").alias("betweenness")), "node", "left").fillna(0.0, ["betweenness"])


#: Sources whose searches are kept at once where joins do the searching.
SOURCES_AT_ONCE = 256


def _betweenness_by_joins(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The same by two joins a level: shortest paths are counted outwards, what hangs on a node is added up backwards.

    Batches of sources bound what is kept to a row for each source of a batch and node.
    """
    e = cut(edges.where("src <> dst"), "adjacency")
    known = nodes.select("node").distinct()
    batches = max(1, -(-known.count() // SOURCES_AT_ONCE))
    out = None
    for batch in range(batches):
        start = known.where(F.pmod(F.xxhash64("node"), F.lit(batches)) == batch)
        levels = [cut(start.select(F.col("node").alias("s"), F.col("node").alias("v"), F.lit(1.0).alias("paths")), "level")]
        seen = levels[0].select("s", "v")
        while True:
            step = levels[-1].join(e, F.col("v") == F.col("src")).groupBy("s", F.col("dst").alias("v")).agg(F.sum("paths").alias("paths"))
            level = cut(step.join(seen, ["s", "v"], "left_anti"), "level")
            if level.isEmpty():
                break
            levels.append(level)
            seen = seen.unionByName(level.select("s", "v"))
        owed, parts = None, []
        for nearer, level in zip(levels[-2::-1], levels[:0:-1]):
            w = level.withColumn("owed", F.lit(0.0)) if owed is None else level.join(owed, ["s", "v"], "left").fillna(0.0, ["owed"])
            parts.append(w.select(F.col("v").alias("node"), F.col("owed").alias("part")))
            back = w.select("s", F.col("v").alias("dst"), ((1 + F.col("owed")) / F.col("paths")).alias("share")).join(e, "dst").select("s", F.col("src").alias("v"), "share")
            owed = cut(back.join(nearer, ["s", "v"]).groupBy("s", "v").agg(F.sum(F.col("share") * F.col("paths")).alias("owed")), "owed")
        for part in parts:
            out = part if out is None else out.unionByName(part)
        if out is not None:
            out = cut(out.groupBy("node").agg(F.sum("part").alias("part")), "parts")
    if out is None:
        return known.withColumn("betweenness", F.lit(0.0))
    return nodes.select("node").join(out.withColumnRenamed("part", "betweenness"), "node", "left").fillna(0.0, ["betweenness"])


def communities(nodes: DataFrame, edges: DataFrame, levels: int = 10, rounds: int = 10) -> DataFrame:
    """node, community by local moves that raise modularity, on the graph and then on its communities.

    In a round half of the nodes (by hash) may move, each to the neighbouring community with the
    largest gain, ties to the smallest id, so no two neighbours chase each other for long.  A level
    ends when nothing has moved in two rounds, or after ``rounds``; all ends when a level joins
    nothing, or after ``levels``.
    """
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    graph = cut(both.where("src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("w")), "graph")
    label = nodes.select("node", F.col("node").alias("community"))
    for _ in range(levels):
        total = graph.agg(F.sum("w")).first()[0] or 0.0
        if not total:
            break
        own = graph.groupBy(F.col("src").alias("node")).agg(F.sum("w").alias("k"))
        place = cut(own.select("node", F.col("node").alias("c"), "k"), "place")
        still = 0
        for r in range(rounds):
            mass = place.groupBy("c").agg(F.sum("k").alias("mass"))
            near = graph.where("src <> dst").join(place.select(F.col("node").alias("dst"), F.col("c").alias("to")), "dst").groupBy(F.col("src").alias("node"), "to").agg(F.sum("w").alias("links"))
            here = place.select("node", F.col("c").alias("to"), F.lit(0.0).alias("links"))
            options = near.unionByName(here).groupBy("node", "to").agg(F.sum("links").alias("links")).join(mass.withColumnRenamed("c", "to"), "to").join(place, "node")
            gain = F.col("links") - F.col("k") * (F.col("mass") - F.when(F.col("to") == F.col("c"), F.col("k")).otherwise(0.0)) / total
            best = Window.partitionBy("node").orderBy(F.desc(F.round("gain", 9)), F.asc("to"))
            moved = options.withColumn("gain", gain).withColumn("r", F.row_number().over(best)).where("r = 1")
            may = F.pmod(F.xxhash64("node", F.lit(r)), F.lit(2)) == 0
            moved = cut(moved.select("node", F.when(may, F.col("to")).otherwise(F.col("c")).alias("to"), "c", "k"), "place")
            still = 0 if moved.where("to <> c").limit(1).count() else still + 1
            release(place)
            place = moved.select("node", F.col("to").alias("c"), "k")
            if still == 2:
                break
        if place.where("node <> c").limit(1).count() == 0:
            break
        label = cut(label.join(place.select(F.col("node").alias("community"), F.col("c").alias("up")), "community", "left").select("node", F.coalesce("up", "community").alias("community")), "label")
        graph = (
            graph.join(place.select(F.col("node").alias("src"), F.col("c").alias("a")), "src").join(place.select(F.col("node").alias("dst"), F.col("c").alias("b")), "dst")
            .groupBy(F.col("a").alias("src"), F.col("b").alias("dst")).agg(F.sum("w").alias("w"))
        )
        graph = cut(graph, "graph")
    return label


def modularity(label: DataFrame, edges: DataFrame) -> float:
    """Of a partition ``label(node, community)`` of the undirected graph."""
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).where("src <> dst")
    tagged = both.join(label.select(F.col("node").alias("src"), F.col("community").alias("a")), "src").join(label.select(F.col("node").alias("dst"), F.col("community").alias("b")), "dst")
    row = tagged.agg(F.count("*").alias("m"), F.count(F.when(F.col("a") == F.col("b"), 1)).alias("inside")).first()
    if not row.m:
        return 0.0
    squares = tagged.groupBy("a").agg(F.count("*").alias("k")).agg(F.sum(F.pow(F.col("k") / row.m, 2))).first()[0]
    return row.inside / row.m - squares
