"""Partitioned Parquet tables: append, per-partition overwrite, and added columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestrata.operators.columns import quoted
from tidestrata.workspace import shuffles_removed

# Makes an overwrite replace the partitions it writes and leave the others. Kept on the table,
# not the session, so jobs running side by side cannot change it for one another.
PER_PARTITION = {"partitionOverwriteMode": "dynamic"}
# Parquet codec of new tables.
TABLE_CODEC = {"compression": "zstd"}


def spread(frame: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows gathered by partition, a partition too big for one file split over several tasks.

    Without it every task would write a file into every partition; with a plain repartition the
    largest region would be one task.
    """
    return frame.hint("rebalance", *partition_by)


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create(frame: DataFrame, name: str, partition_by: Sequence[str]) -> None:
    database, _, _ = name.rpartition(".")
    if database:
        frame.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    with shuffles_removed(frame.sparkSession):
        (
            frame.write.format("parquet")
            .options(**PER_PARTITION, **TABLE_CODEC)
            .partitionBy(*partition_by)
            .saveAsTable(name)
        )


def evolve(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` in the table's column order, new columns added to the table first.

    A column only the table has is null in the result. Types are the table's.
    """
    spark = frame.sparkSession
    known = set(spark.table(name).columns)
    added = [f for f in frame.schema.fields if f.name not in known]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    given = set(frame.columns)
    return frame.select(
        *[
            (quoted(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in spark.table(name).schema.fields
        ]
    )


def append(
    frame: DataFrame,
    name: str,
    partition_by: Sequence[str] = ("region",),
    *,
    spread_rows: bool = True,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Add rows, creating the table in the catalogue if needed.

    ``then`` derives further columns of rows that have been gathered by partition, so they need not travel.
    """
    if spread_rows:
        frame = spread(frame, partition_by)
    if then:
        frame = then(frame)
    if exists(frame.sparkSession, name):
        rows = evolve(frame, name)
        with shuffles_removed(frame.sparkSession):
            rows.write.insertInto(name)
    else:
        create(frame, name, partition_by)


def overwrite_partitions(
    frame: DataFrame,
    name: str,
    partition_by: Sequence[str] = ("region",),
    *,
    spread_rows: bool = True,
) -> None:
    """Replace the partitions that ``frame`` has rows for; running it again changes nothing."""
    spark = frame.sparkSession
    if spread_rows:
        frame = spread(frame, partition_by)
    if not exists(spark, name):
        create(frame, name, partition_by)
        return
    settings = ", ".join(f"'{key}'='{value}'" for key, value in PER_PARTITION.items())
    spark.sql(f"ALTER TABLE {name} SET SERDEPROPERTIES ({settings})")
    rows = evolve(frame, name)
    with shuffles_removed(spark):
        rows.write.insertInto(name, overwrite=True)
