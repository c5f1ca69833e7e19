"""Ranks inside large groups.

A window over a region sorts the whole region in one task. Here the rows are range-partitioned
by region and rank order instead, so a region is spread over as many tasks as its size needs;
each row's rank is its place in its slice plus the sizes of the region's earlier slices.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidestrata.operators.bounds import broadcast_if_small
from tidestrata.workspace import scratch_folder

SERIAL, SLICE, FIRST, BEFORE = "_serial", "_slice", "_first", "_before"

# monotonically_increasing_id() is the partition number above 33 bits of place in it.
PLACE_BITS = 33


def with_rank(frame: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """``frame`` with its row number in ``group`` by ``order``, as ``name``.

    Slice limits come from a sample, so the sliced rows are written once to the shared folder, where
    they stay until the session ends: their count and their numbering have to see the same slices,
    also after a lost executor.
    """
    spark = frame.sparkSession
    sliced = frame.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    folder = scratch_folder(spark, "ranks")
    numbered = sliced.withColumn(SERIAL, F.monotonically_increasing_id())
    numbered.write.parquet(folder)
    stored = spark.read.schema(numbered.schema).parquet(folder)

    slice_of = F.shiftright(SERIAL, PLACE_BITS)
    runs = stored.groupBy(*group, slice_of.alias(SLICE)).agg(
        F.min(SERIAL).alias(FIRST), F.count(F.lit(1)).alias("rows")
    )
    earlier = Window.partitionBy(*group).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *[F.col(c).alias(f"_{c}") for c in group],
        SLICE,
        FIRST,
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias(BEFORE),
    )

    same_run = reduce(
        and_,
        [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group],
        slice_of == F.col(SLICE),
    )
    rank = F.col(SERIAL) - F.col(FIRST) + F.col(BEFORE) + 1
    return stored.join(broadcast_if_small(runs), same_run).select(
        *frame.columns, rank.cast("int").alias(name)
    )
