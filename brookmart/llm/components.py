"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on (a, b) edges with a > b; the result has a > b again."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if large:
        # neighbours above a node are tied to the least of the node and its neighbours
        near = both
        least = near.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        out = near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        # a node and its neighbours below it are tied to the least of these
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        out = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.filter("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; the root is the least node reachable.

    ``edges`` has columns a and b in any order. The number of rounds grows with the
    logarithm of the longest path; each round is written to the shared folder.
    """
    edges = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(),
        "edges")
    last = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == last or now[0] == 0:
            break
        last = now
        edges = stored(_star(stored(_star(edges, True), "edges"), False), "edges")
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
