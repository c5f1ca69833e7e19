"""Merging new records into a table that keeps one record per key."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestrata.operators.bounds import broadcast_if_small
from tidestrata.operators.latest import latest_records
from tidestrata.schemas import RECORD_KEY
from tidestrata.sinks.tables import append, evolve, exists, overwrite_partitions
from tidestrata.sources.tables import table
from tidestrata.workspace import shared_folder, shuffles_removed

# Parquet codec of staged rows: some 0.8 of their size under Spark's default, JSON text half of it.
STAGED_CODEC = "zstd"


def stored(frame: DataFrame, path: str) -> DataFrame:
    """``frame`` written to ``path`` and read back: later steps do not compute it again.

    What the write has shuffled is removed when it is done.
    """
    with shuffles_removed(frame.sparkSession):
        frame.write.option("compression", STAGED_CODEC).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(spark: SparkSession, folder: str) -> None:
    """Remove a staging folder once its rows are in the table."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def only_partitions(frame: DataFrame, touched: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of ``frame`` in the partitions listed in ``touched``.

    The last of ``columns`` may have any number of values. For each combination of the others, such
    as a region, their range goes into the scan as a partition filter, and a join on all columns
    then picks the partitions exactly. The driver holds one row per combination. The list is broadcast
    where it is small, so that the rows of ``frame`` are not shuffled for the join.
    """
    *outer, inner = columns
    known = touched.groupBy(*outer).agg(
        F.min(inner).alias("_first"),
        F.max(inner).alias("_last"),
        F.max(F.col(inner).isNull()).alias("_null"),
    )
    branches = []
    for row in known.collect():
        within = F.col(inner).between(F.lit(row["_first"]), F.lit(row["_last"]))
        if row["_null"]:
            within = F.col(inner).isNull() if row["_first"] is None else within | F.col(inner).isNull()
        branches.append(reduce(and_, [F.col(c).eqNullSafe(F.lit(row[c])) for c in outer], within))
    if not branches:
        return frame.limit(0)
    other = touched.select(*[F.col(c).alias(f"_{c}") for c in columns])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    return frame.where(reduce(or_, branches)).join(broadcast_if_small(other), same, "left_semi")


def merge_latest(
    records: DataFrame,
    name: str,
    partition_by: Sequence[str],
    key: Sequence[str] = RECORD_KEY,
    *,
    at_rest: bool = False,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Put ``records``, one per key, into the table; per key the newest record stays.

    Records ``at_rest`` are read from files already and need not be staged. ``then`` derives columns of them
    that the table has too (``sinks.append``).

    Only partitions that get new rows are read and rewritten. The merged rows are complete in the
    shared folder before the first partition is replaced: a job that ends before that leaves the
    table as it was, and one whose driver ends during it leaves the staged rows there to load with
    ``overwrite_partitions``. Running a merge again gives the same table. ``partition_by`` must be
    part of the key.
    """
    if not set(partition_by) <= set(key):
        raise ValueError(f"partition columns {partition_by} have to be part of the key {key}")
    spark: SparkSession = records.sparkSession
    if not exists(spark, name):
        append(records, name, partition_by, then=then)
        return
    # A folder of its own, so that runs for tables of the same name cannot meet in it.
    folder = f"{shared_folder(spark)}/merge/{name.replace('.', '/')}/{uuid.uuid4().hex}"
    incoming = evolve(then(records) if then else records, name)
    incoming = incoming if at_rest else stored(incoming, f"{folder}/incoming")
    touched = stored(incoming.select(*partition_by).distinct(), f"{folder}/touched")
    current = only_partitions(table(spark, name), touched, partition_by)
    merged = latest_records(current.unionByName(incoming), key)
    # Gathered by partition only after staging: the two shuffles are never on disk together.
    ready = stored(merged, f"{folder}/merged")
    overwrite_partitions(ready, name, partition_by)
    discard(spark, folder)
