"""Connected components of a graph by alternating star joins, one written table a round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.session import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _to_smallest(pairs: DataFrame) -> DataFrame:
    """(a, b) with the smallest of a and all its b as ``least``; the join splits hot nodes at run time."""
    least = pairs.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("least"))
    return pairs.join(least, "a")


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the component's smallest node.

    Each round links every node to the smallest node it sees, first from its larger
    neighbours, then from its smaller ones; it ends when the edges are stars, after
    a number of rounds that grows with the logarithm of the longest path. Nothing
    but a count and a checksum reaches the driver.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = _signature(now)
    while seen[0]:
        large = _to_smallest(_both_ways(now)).where("b > a AND b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        stars = _to_smallest(large.distinct())
        small = stars.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        own = stars.select("a", F.col("least").alias("b"))
        now = materialize(small.unionByName(own).distinct(), "links")
        found = _signature(now)
        if found == seen:
            break
        seen = found
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
