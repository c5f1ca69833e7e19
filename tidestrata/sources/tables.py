"""Catalogue tables, addressed by name."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def table(spark: SparkSession, name: str) -> DataFrame:
    """The table as the catalogue has it now, with files written since it was last read."""
    frame = spark.table(name)
    spark.catalog.refreshTable(name)
    return frame


def optional_table(spark: SparkSession, name: str) -> DataFrame | None:
    """The table, or None where it is missing or cannot be resolved."""
    try:
        return table(spark, name)
    except AnalysisException as problem:
        log.warning("going on without %s: %s", name, problem)
        return None


def has_rows(frame: DataFrame) -> bool:
    """Whether there is any row; stops at the first one found."""
    return not frame.isEmpty()


def bounded_sample(frame: DataFrame, rows: int, key: Sequence[str] = ()) -> DataFrame:
    """``rows`` rows, for a check that need not see the whole table.

    Without a ``key`` they are any rows, and reading stops once there are enough. With the names of key
    columns they are those whose digest of the key is smallest: the same in every run and partitioning,
    and no better or worse than others. That reads the table, but every task keeps only so many rows.
    Rows of equal keys should be equal in what is checked.
    """
    if not key:
        return frame.limit(rows)
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]))
    return frame.orderBy(digest, *key).limit(rows)
