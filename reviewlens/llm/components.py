"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import stage


def large_star(edges: DataFrame) -> DataFrame:
    """Each node points its larger neighbours at the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node points its smaller neighbours, and itself, at the smallest of them. Edges run from large to small."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for every node of an edge, the smallest node it is linked with.

    edges has columns u and v in any order; loops and repeats do no harm.
    Every round is written to the shared folder. Rounds end when an alternation
    changes nothing; their number grows with the logarithm of the nodes.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    edges, seen = stage(edges, "edges"), None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 31))).first()
        if mark == seen:
            break
        seen = mark
        edges = stage(small_star(large_star(edges)), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
