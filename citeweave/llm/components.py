"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.shared import staged

#: A node with more edges than this is a hub, and MOST_HUBS nodes may be at most.
HUB, MOST_HUBS = 100_000, 100_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _with_least(edges: DataFrame, least: DataFrame, count: int) -> DataFrame:
    """(a, b, m) of edges (a, b): m is what least (a, m, degree) has of a.

    A hub's edges would meet in one task, so hubs' rows are sent to all workers instead.
    A hub has more than its share of all edges, so there are MOST_HUBS of them at most.
    """
    bound = max(HUB, count // MOST_HUBS)
    if count <= bound:  # no node can have more edges than there are
        return edges.join(least.select("a", "m"), "a")
    least = staged(least)
    hubs = staged(least.where(F.col("degree") > bound).select("a", "m"))
    if hubs.isEmpty():
        return edges.join(least.select("a", "m"), "a")
    rest = edges.join(F.broadcast(hubs), "a", "left_anti").join(least.where(F.col("degree") <= bound).select("a", "m"), "a")
    return rest.unionByName(edges.join(F.broadcast(hubs), "a"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b): root is the least node it is connected with.

    Each round first hangs every node's larger neighbours on its least one, then its
    smaller ones, until every node hangs on its root; rounds grow with the logarithm of
    the number of nodes. A node's neighbours are only ever reduced to a minimum, never
    gathered, and hubs' edges stay where they are. Loops (a = b) and repeated edges change nothing. Nulls are not allowed.
    """
    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("degree")).select("a", F.least("a", "m").alias("m"), "degree")
        large = _with_least(both, least, 2 * before[0]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        root = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("degree"))
        small = _with_least(large, root, 2 * before[0]).select("a", "b", "m")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = staged(small)
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
