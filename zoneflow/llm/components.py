"""Connected components by alternating large-star and small-star steps on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node, root`` (the smallest node of its component) for every node of ``links`` (two
    long columns ``x, y``; loops and repeats are fine). Nodes without links are not listed.

    Each step keeps every component connected and moves edges towards its smallest node, until
    all edges are (node, root). Only edge tables are joined; the driver sees a checksum.
    """
    edges = written(links.where("x != y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "cc-edges")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = written(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "cc-edges")
        row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))).alias("h")).first()
        if (row["n"], row["h"]) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = (row["n"], row["h"])
