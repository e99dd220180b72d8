"""Connected components of an undirected graph by alternating stars, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstrand.llm.common import stored


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for edges (a, b): the least node that each node reaches.

    Large-star hangs a node's larger neighbours on its least one, small-star its smaller ones, in
    turn, until nothing changes; the graph is then a set of stars. Every round is written to shared
    storage; if `rounds` do not do, it is an error. A hub's neighbours are never gathered: least neighbours are pre-aggregated and joined
    back, which adaptive execution may split.
    """

    def star(pairs: DataFrame) -> DataFrame:
        """pairs (u, v): each v and u itself on the least of v and u."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hung = pairs.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return hung.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").groupBy("a", "b").agg(F.lit(1).alias("one")).select("a", "b")

    # of an edge the larger node comes first
    now = stored(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).groupBy("a", "b").agg(F.lit(1).alias("one")).select("a", "b"), "edges")
    before = None
    for _ in range(rounds):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").groupBy("a", "b").agg(F.lit(1).alias("one")).select("a", "b")
        now = stored(star(large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components are not settled after {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
