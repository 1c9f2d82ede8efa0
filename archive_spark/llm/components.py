"""Connected components of links, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _stars(edges: DataFrame) -> DataFrame:
    """One large and one small star step; every edge (a, b) then has a > b."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = materialize(least.select("a", F.least("a", "m").alias("m")), "star-centres")
    large = both.join(least, "a").filter(F.col("b") > F.col("a"))
    large = materialize(large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "star-edges")
    least = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "star-centres")
    small = large.join(least, "a").filter(F.col("b") != F.col("m"))
    small = small.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.union(least.select("a", F.col("m").alias("b"))).distinct()


def _print(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    row = edges.agg(
        F.count("*").alias("n"), F.sum(h.cast("decimal(20,0)")).alias("s"), F.bit_xor(h).alias("x")
    ).first()
    return row["n"], row["s"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b); the root is the smallest of its component.

    Every node is sent once a step to the smallest one around it, so the number of steps
    grows with the logarithm of the nodes. Each step is written to a table and read back.
    A root has no row of its own. Edges from a node to itself are left out.
    """
    edges = edges.select("a", "b").filter(F.col("a") != F.col("b")).distinct()
    edges = materialize(edges, "component-edges")
    before = _print(edges)
    while before[0]:
        edges = materialize(_stars(edges), "component-edges")
        after = _print(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
