"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

C = F.col


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's least neighbour (or itself)."""
    both = edges.union(edges.select(C("v").alias("u"), C("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).withColumnRenamed("u", "n")
    out = both.filter(C("v") > C("u")).join(least, C("u") == C("n")).select(C("v").alias("u"), C("m").alias("v"))
    return out.filter(C("u") != C("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links every smaller neighbour of a node, and the node, to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "n")
    moved = edges.join(least, C("u") == C("n")).select(C("v").alias("u"), C("m").alias("v"))
    return moved.union(least.select(C("n").alias("u"), C("m").alias("v"))).filter(C("u") != C("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links u - v (bigint), root the least node of its component.

    Nodes without a link are absent; self-links are dropped. Each round is two aggregations by
    minimum and two joins, whatever a node's degree, and is written to the shared folder; rounds end when the
    links no longer change, after about the logarithm of the longest path.
    """
    now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter(C("u") != C("v")).distinct())
    mark = None
    while True:
        now = written(_small_star(_large_star(now)))
        found = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (found["n"], found["h"]) == mark or not found["n"]:
            return now.select(C("u").alias("node"), C("v").alias("root")).union(now.select(C("v").alias("node"), C("v").alias("root")).distinct())
        mark = (found["n"], found["h"])
