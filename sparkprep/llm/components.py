"""Connected components of a table of links, by contraction.

A round gives every node the neighbour (or itself) that comes first in an
order hashed anew for the round, merges the node into it and drops the links
that fall inside a merged node. The hashed order lets any shape, a long chain
too, shrink by a constant factor, so rounds grow with the logarithm of the
longest chain. All steps are aggregates combined before the shuffle and joins
that Spark may split; a node with very many links is no single task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link; root is some node of its component."""
    ordered = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    edges = materialize(ordered.where("a < b").distinct())
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        order = lambda c: F.xxhash64(F.col(c), F.lit(len(rounds)))  # noqa: B023, E731
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).withColumn("h", order("b"))
        near = both.groupBy("a").agg(F.min_by("b", "h").alias("first"), F.min("h").alias("h"))
        into = materialize(near.select("a", F.when(F.col("h") < order("a"), F.col("first")).otherwise(F.col("a")).alias("into")))
        rounds.append(into)
        left = into.select("a", F.col("into").alias("x"))
        right = into.select(F.col("a").alias("b"), F.col("into").alias("y"))
        merged = edges.join(left, "a").join(right, "b").where("x <> y")
        edges = materialize(merged.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    root = rounds[-1].select(F.col("a").alias("node"), F.col("into").alias("root"))
    for into in reversed(rounds[:-1]):
        later = root.select(F.col("node").alias("into"), F.col("root").alias("later"))
        root = into.join(later, "into", "left").select(F.col("a").alias("node"), F.coalesce("later", "into").alias("root"))
    return root
