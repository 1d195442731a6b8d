"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparge.llm.common import write_stage

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b), a > b.

    Large: every larger neighbour of a node is linked to the node's smallest neighbour (or the node itself).
    Small: every smaller neighbour, and the node, are linked to the smallest of them.
    The smallest neighbour is a map-side minimum and comes back by a join, so no node's neighbours are gathered.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("near"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("near")))
    least = both.groupBy("node").agg(F.min("near").alias("least"))
    joined = both.join(least, "node")
    if large:
        root = F.least("node", "least")
        out = joined.filter(F.col("near") > F.col("node")).select(F.col("near").alias("a"), root.alias("b"))
    else:
        out = joined.select(F.col("near").alias("a"), F.col("least").alias("b"))
        out = out.unionByName(least.select(F.col("node").alias("a"), F.col("least").alias("b")))
    return out.filter("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of `edges` (a, b, both long): the smallest node reachable from it.

    Direction, repeats and loops (a = b) do not matter; a node that occurs only in loops is left out, as is a null.
    Each round is written to the shared folder. Stops when a round changes nothing; the number of rounds grows with
    the logarithm of the longest chain, and more than MAX_ROUNDS is an error rather than a wrong result.
    """
    now = write_stage(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    state = None
    for _ in range(MAX_ROUNDS):
        now = write_stage(_star(_star(now, large=True), large=False), "edges")
        # The sum of hashes tells whether the set of edges has changed; it is exact but for a chance of 2^-64.
        row = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = tuple(row)
    raise RuntimeError(f"components did not settle within {MAX_ROUNDS} rounds")
