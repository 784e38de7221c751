"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetboard.session import land


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node in ``edges`` (a long, b long); a component is named by its least node.

    Every round hangs each node's larger neighbours under its least one, then its smaller ones, until the
    edges are stars. Degrees are never gathered: a node's least neighbour is an aggregate, joined back.
    Rounds are written to the shared folder, so that a lost executor repeats one round only.
    """
    edges = land(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select(
            F.col("a").alias("node"), F.least("a", "least").alias("least"))
        large = both.where("b > a").join(least, F.col("a") == F.col("node")).select(
            F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        large = land(large.where("a <> b"), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("least")).withColumnRenamed("a", "node")
        small = large.join(least, F.col("a") == F.col("node"))
        small = small.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            small.select("a", F.col("least").alias("b")))
        edges = land(small.where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "small-star")
    else:
        raise RuntimeError("components did not settle")
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
