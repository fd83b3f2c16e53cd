"""Connected components of an undirected graph, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epilake.llm.tables import stored


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, component)`` of every node in ``links(a, b)``; component: the smallest node reachable.

    Alternates two steps (large star, small star) that hang a node's neighbours
    on the smallest of them, until nothing changes: a number of rounds that
    grows with the logarithm of the longest path. Each round is written to the
    shared folder. A node with very many neighbours is never gathered: its least
    neighbour comes from an aggregate, and the join that follows can be split.
    No links give no rows.
    """
    edges = stored(_ordered(links), "links")
    last = None
    for _ in range(rounds):
        edges = stored(_small_star(_large_star(edges)), "links")
        state = edges.agg(F.count("*"), F.sum("low"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            break
        last = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    nodes = edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return nodes.union(edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct())


def _ordered(links: DataFrame) -> DataFrame:
    """Each link once, from its larger end to its smaller."""
    return links.where("a != b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of every node on the least of its neighbourhood."""
    both = edges.select(F.col("high").alias("n"), F.col("low").alias("m"))
    both = both.union(edges.select(F.col("low").alias("n"), F.col("high").alias("m")))
    # A table of its own, so that the join can split a node with very many neighbours.
    least = stored(both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("least")), "least")
    return _ordered(both.join(least, "n").where("m > n").select(F.col("m").alias("a"), F.col("least").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    joined = edges.join(least, "high").select(F.col("low").alias("a"), F.col("least").alias("b"))
    return _ordered(joined.union(least.select(F.col("high").alias("a"), F.col("least").alias("b"))))
