"""Joins that follow patterns of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def mutual(edges: DataFrame) -> DataFrame:
    """a < b for every pair with an edge either way."""
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return edges.select("src", "dst").join(back, ["src", "dst"], "left_semi").where("src < dst").select(F.col("src").alias("a"), F.col("dst").alias("b"))


def one_sided(edges: DataFrame) -> DataFrame:
    """Edges whose reverse is not there."""
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return edges.join(back, ["src", "dst"], "left_anti")


def co_neighbours(edges: DataFrame) -> DataFrame:
    """a, b, via for every pair a < b with an edge to one and the same node."""
    e = edges.select("src", "dst").distinct()
    x, y = e.select(F.col("src").alias("a"), F.col("dst").alias("via")), e.select(F.col("src").alias("b"), F.col("dst").alias("via"))
    return x.join(y, "via").where("a < b").select("a", "b", "via")


def two_hops(edges: DataFrame) -> DataFrame:
    """src, mid, dst over two different edges."""
    first = edges.select("src", F.col("dst").alias("mid"))
    second = edges.select(F.col("src").alias("mid"), "dst")
    return first.join(second, "mid").where("NOT (src = mid AND mid = dst)").select("src", "mid", "dst")


def hops_from(start: DataFrame, edges: DataFrame, most: int) -> DataFrame:
    """start, node, hops: every node reached over 1 to ``most`` edges, with its least number.

    Each round expands only nodes not seen before, so circles end and paths never multiply.
    """
    frontier = start.select(F.col("node").alias("start"), "node")
    seen = frontier.withColumn("hops", F.lit(0))
    for hop in range(1, most + 1):
        step = frontier.join(edges.select(F.col("src").alias("node"), F.col("dst").alias("next")), "node").select("start", F.col("next").alias("node")).distinct()
        frontier = cut(step.join(seen, ["start", "node"], "left_anti"), "frontier")
        seen = seen.unionByName(frontier.withColumn("hops", F.lit(hop)))
    return seen.where("hops > 0")


def typed_paths(start: DataFrame, edges: DataFrame, most: int) -> DataFrame:
    """start, node, hops, path, types: all paths of 1 to ``most`` edges that use no edge twice.

    ``edges`` has src, dst, rel_type and is taken in the directions it holds.
    """
    hop = edges.select(F.col("src").alias("node"), F.col("dst").alias("next"), "rel_type")
    edge = F.concat_ws("|", F.least("node", "next").cast("string"), F.greatest("node", "next").cast("string"), "rel_type")
    hop = hop.withColumn("edge", edge)
    paths = start.select(F.col("node").alias("start"), "node", F.array("node").alias("path"), F.array().cast("array<string>").alias("types"), F.array().cast("array<string>").alias("used"))
    out = None
    for n in range(1, most + 1):
        paths = paths.join(hop, "node").where("NOT array_contains(used, edge)").select(
            "start", F.col("next").alias("node"), F.concat("path", F.array("next")).alias("path"),
            F.concat("types", F.array("rel_type")).alias("types"), F.concat("used", F.array("edge")).alias("used"),
        )
        paths = cut(paths, "paths")
        one = paths.withColumn("hops", F.lit(n)).drop("used")
        out = one if out is None else out.unionByName(one)
    return out
