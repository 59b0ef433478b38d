"""Connected components of an edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import cut, remove


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % (1 << 40)).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its smallest node.

    In a large star every larger neighbour of a node moves to the node's smallest neighbour, in a small star
    every smaller one does; after a number of rounds that grows with the logarithm of the longest chain, every
    edge leads to the smallest node. Each round is two grouped minima and two joins over edges; it is written
    to the work folder and ends the lineage. The minima are written before they are joined: a join right above an
    aggregate could not split the rows of a node that has very many neighbours.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = cut(edges.where("a <> b").select(larger, smaller).distinct(), folder, f"{name}-0")
    before, turn = None, 0
    while (now := _state(edges)) != before:
        before, turn = now, turn + 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        least = cut(least, folder, f"{name}-{turn}-least-large")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut(large.where("a <> b").distinct(), folder, f"{name}-{turn}-large")
        least = cut(large.groupBy("a").agg(F.min("b").alias("m")), folder, f"{name}-{turn}-least-small")
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(moved.unionByName(least.withColumnRenamed("m", "b")).distinct(), folder, f"{name}-{turn}")
        remove(edges.sparkSession, folder, *[f"{name}-{turn}-{part}" for part in ("least-large", "large", "least-small")])
        remove(edges.sparkSession, folder, f"{name}-{turn - 1}")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
