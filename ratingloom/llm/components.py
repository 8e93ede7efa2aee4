"""Connected components of an edge table by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import lookup_join, written


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = lookup_join(both, least, "u", "v", how="inner").where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = lookup_join(edges, least, "u", "v", how="inner").where("v > m")
    lower = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lower.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node but the smallest of each component.

    ``edges`` has u and v of any orderable type. Every round is written to the shared
    folder, and hot nodes are dealt over tasks, so no node's edges meet in one task.
    """
    oriented = edges.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    current = written(oriented.distinct(), "edges")
    before = _state(current)
    while before[0]:
        current = written(_small_star(written(_large_star(current), "large-star")), "small-star")
        after = _state(current)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
