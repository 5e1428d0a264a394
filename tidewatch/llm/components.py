"""Connected components of a graph given as pairs, in alternating star rounds over a table that stays in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import pinned


def _towards_smallest(edges: DataFrame) -> DataFrame:
    """Large star: every larger neighbour of a node is linked to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(smallest, "a").select(F.col("m").alias("a"), "b")


def _among_smaller(edges: DataFrame) -> DataFrame:
    """Small star: a node and its smaller neighbours are linked to the smallest of these."""
    smallest = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(smallest, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(smallest.select(F.col("m").alias("a"), "b")).where("a < b")


def components(pairs: DataFrame) -> DataFrame:
    """(node, component) for every node of `pairs(a, b)`: the smallest node it is connected with.

    Alternating large and small stars (after Kiveris et al.) until every edge leads from a smallest node to a leaf: a number
    of rounds that grows with the logarithm of the longest chain. Each round folds neighbourhoods before shuffling them, so a
    node with very many neighbours is split over the tasks, and is written, so that a lost executor repeats one round only.
    """
    edges = pinned(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                   .where("a < b").distinct())
    while not edges.select("a").join(edges.select(F.col("b").alias("a")), "a", "left_semi").isEmpty() or not (
            edges.groupBy("b").count().where("count > 1").isEmpty()):
        edges = pinned(_among_smaller(_towards_smallest(edges)).distinct())
    members = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return members.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def merged_components(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """`found(node, component)` after adding further pairs: only the components that these join are worked on."""
    def label(name: str) -> DataFrame:
        return found.select(F.col("node").alias(name), F.col("component").alias(f"of_{name}"))

    joined = pairs.join(label("a"), "a", "left").join(label("b"), "b", "left").select(
        "a", "b", F.coalesce("of_a", "a").alias("of_a"), F.coalesce("of_b", "b").alias("of_b"))
    above = pinned(components(joined.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))))
    nodes = found.unionByName(joined.select(F.col("a").alias("node"), F.col("of_a").alias("component"))).unionByName(
        joined.select(F.col("b").alias("node"), F.col("of_b").alias("component"))).distinct()
    moved = nodes.join(above.select(F.col("node").alias("component"), F.col("component").alias("_above")), "component", "left")
    return pinned(moved.select("node", F.coalesce("_above", "component").alias("component")))
