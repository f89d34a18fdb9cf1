"""Connected components by alternating large-star and small-star.

Edges only, as a DataFrame of (u, v); each step is an aggregate (the smallest
neighbour of every node) and a join, written to the shared folder so that the
lineage stays short.  A node with very many neighbours is a hot key of the
join's large side, whose small side has one row per node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.session import materialize


def _stars(edges: DataFrame) -> bool:
    """Every u has one v, and no v is a u: each component is a star."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("out")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("out")))).alias("e"))
    nodes = ends.groupBy("e.node").agg(F.sum("e.out").alias("out"), F.min("e.out").alias("least"))
    return nodes.where("out > 1 OR (out = 1 AND least = 0)").count() == 0


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node but the
    smallest of each component."""
    edges = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .distinct(), "edges")
    while not _stars(edges):
        edges = materialize(_small_star(_large_star(edges)), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
