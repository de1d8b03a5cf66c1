"""Connected components of an edge table, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellfold.session import Stages


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest in its circle."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(low, "u").filter("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).filter("u != v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is tied to the smallest."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(low.select("u", F.col("m").alias("v"))).filter("u != v")


def components(edges: DataFrame, stages: Stages, tag: str = "components") -> DataFrame:
    """``node``, ``label``: the smallest node of its component, for every node
    of ``edges`` (u, v; longs). Large-star and small-star steps alternate, as
    published, until nothing changes; every step is written to the shared
    folder, and only two numbers a step reach the driver."""
    now = stages.save(edges.select("u", "v").filter("u != v").distinct(), tag)
    sign = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    seen = tuple(now.agg(*sign).first())
    while seen[0]:
        now = stages.save(_small_star(_large_star(now).distinct()).distinct(), tag)
        found = tuple(now.agg(*sign).first())
        if found == seen:
            break
        seen = found
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
