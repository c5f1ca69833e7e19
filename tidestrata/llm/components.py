"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestrata.workspace import prepare_checkpoints


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Alternates large and small stars: each node hands its neighbours over to the smallest node it
    knows, which takes rounds in the logarithm of the longest path. A round groups and joins edges
    by node, so the neighbours of a hub are never gathered, and ends in a checkpoint. Only two
    numbers per round reach the driver. Edges with a null end are left out.
    """
    prepare_checkpoints(edges.sparkSession)
    stars = (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
        .checkpoint()
    )
    seen = None
    while (now := _signature(stars)) != seen:
        if now[0] == 0:
            break
        seen = now
        stars = _small_star(_large_star(stars)).checkpoint()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _signature(stars: DataFrame) -> tuple:
    row = stars.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(
        F.col("v").alias("u"), F.col("m").alias("v")
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") != F.col("m"))
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v"))
    ).distinct()
