"""Connected components by alternating stars: every node ends beside the smallest node that it can reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.llm.storage import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())


def _least(edges: DataFrame) -> DataFrame:
    """(a, m): the smallest node among a and all its b."""
    return edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def _to_least(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point to the smallest of them."""
    least = _least(edges)
    near = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.unionByName(least.where("a > m").select("a", F.col("m").alias("b"))).distinct()


def _larger_to_least(edges: DataFrame) -> DataFrame:
    """The larger neighbours of each node point to the smallest of it and its neighbours; edges may repeat."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.join(_least(both), "a").where("b > a AND b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b), both long. Self-links and repeated edges are passed over.

    Stops when a round changes nothing; the number of rounds is logarithmic in the length of chains. The driver
    learns a count and a sum a round.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges = cut(_to_least(cut(edges)))  # nodes with many neighbours lose most of their edges before the first round
    before = _state(edges)
    while True:
        edges = cut(_to_least(_larger_to_least(edges)))
        after = _state(edges)
        if after == before:
            break
        before = after
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
