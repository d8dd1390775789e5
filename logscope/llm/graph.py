"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscope.llm.common import keep_table


def _star(edges: DataFrame, label: str) -> DataFrame:
    """Points every ``u``'s partners, and ``u``, at the smallest of them all; edges are (u, v)."""
    least = keep_table(edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), f"{label}-least")
    return edges.join(least, "u")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link to another.

    A step keeps one edge per node and shrinks distances, so that the number of rounds grows
    with the logarithm of the longest chain. Edges are written each round; only a count of the
    changes reaches the driver.
    """
    edges = keep_table(links.where(F.col(a) != F.col(b))
                       .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: each larger partner of u points at the least one.
        # Edges that repeat are at most twice as many as before, and go with the small star's.
        large = keep_table(_star(both, "large").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "large-star")
        # Small star: u and its smaller partners (all are: v < u) point at the least one.
        small = _star(large, "small")
        edges = keep_table(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                           .unionByName(small.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = now
