"""Connected components of an edge table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import joined, written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's neighbours (the larger ones, or the smaller ones and itself) to its minimum.

    A node with a large share of all neighbours (the root of a large class) is no hot task: see ``joined``.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("m", "u"))
    least = written(least, "least")
    linked = joined(both, least.drop("n"), "u", least)
    if large:
        out = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge, root being the least node of its component.

    Alternates large-star and small-star steps; each is written, so that a lost executor
    costs one step, and the loop ends when a round changes nothing.
    """
    edges = written(edges.select("u", "v").where("u != v").distinct(), "edges")
    mark = None
    while True:
        edges = written(_stars(edges, True), "edges")
        edges = written(_stars(edges, False), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    roots = edges.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()
