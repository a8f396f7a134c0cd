"""Connected components of an edge table, without ever gathering a component.

Each round hooks every node to the smallest of itself and its neighbours, follows the hooks a
few steps and contracts the graph to the nodes that are left; a hub is one row of an aggregate
that combines on the map side.  The number of rounds grows with the logarithm of the longest
chain of hooks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Times that hooks are followed, each doubling their reach, before a contraction.
JUMPS = 2


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``edges(a long, b long)``: the smallest node reachable.

    Nodes that only have an edge to themselves get no row.  A table that ``cut`` wrote is read where it is.
    """
    if not hasattr(edges, "_cut_path"):
        edges = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    edges = edges.where("a != b")
    labels = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        hook = cut(both.groupBy("node").agg(F.min("other").alias("o")).select("node", F.least("node", "o").alias("up")), "hooks")
        far = hook
        for _ in range(JUMPS):
            step = far.select(F.col("node").alias("up"), F.col("up").alias("top"))
            far = far.join(step, "up").select("node", F.col("top").alias("up"))
        hook = cut(far, "hooks")
        if labels is None:
            labels = hook.select("node", F.col("up").alias("component"))
        else:
            on = hook.select(F.col("node").alias("component"), "up")
            labels = labels.join(on, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
        labels = cut(labels, "labels")
        edges = (
            edges.join(hook.select(F.col("node").alias("a"), F.col("up").alias("x")), "a")
            .join(hook.select(F.col("node").alias("b"), F.col("up").alias("y")), "b")
            .where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
        edges = cut(edges, "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
