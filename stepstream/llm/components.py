"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepstream.llm.tables import settled

MOST_ROUNDS = 100  # each one shortens every path, so even a chain of 10^12 nodes needs fewer


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of ``edges (a, b)``; the component is its smallest node.

    Alternating stars: every node hands its larger neighbours to the smallest one,
    then its smaller ones. Both steps are a group-by and a join; the edge set is
    settled after each round. The smallest node itself is listed, too.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    links = settled(edges.where("a <> b").select(high.alias("a"), low.alias("b")).distinct())
    before = _state(links)
    for _ in range(MOST_ROUNDS):
        links = settled(_small_star(_large_star(links)))
        now = _state(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    own = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(own)


def _large_star(links):
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links):
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def _state(links):
    return links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20)"))).first()
