"""Connected components of links between documents, as joins and aggregates over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from starmart.session import materialize


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node around it."""
    around = _both(edges)
    least = around.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
    return around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(least.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """a, b (links, each at least once, ids that can be ordered) -> id, root: the smallest id that links reach.

    Only linked ids have a row; a root has one too. The two star steps alternate until nothing moves;
    each round is written, so no plan grows and a lost executor costs one round. The number of rounds
    grows with the logarithm of a component's size; no step holds more than a node's running minimum.
    """
    edges, seen = edges.where("a <> b").select("a", "b"), None
    while True:
        seal = Observation()                      # what a round has written, without another pass over it
        moved = _small_star(_large_star(edges)).observe(
            seal, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"))
        edges = materialize(moved, "links")
        mark = (seal.get["n"], seal.get["h"])
        if mark == seen or not mark[0]:
            break
        seen = mark
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
