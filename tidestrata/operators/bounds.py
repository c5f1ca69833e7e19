"""Broadcasting only what has been measured."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

BROADCAST_LIMIT = 32 * 1024 * 1024
FIELD_BYTES = 16


def row_bytes(frame: DataFrame):
    sizes = [F.lit(FIELD_BYTES * len(frame.columns))]
    for field in frame.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            sizes.append(F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)))
    return reduce(add, sizes).cast("bigint")


def broadcast_if_small(frame: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``frame`` with a broadcast hint if its rows measure at most ``limit`` bytes.

    Runs one counting job over ``frame``, so it is meant for sides that are small or already
    stored. Beyond the limit Spark plans a shuffled join, and adaptive execution splits its
    skewed partitions.
    """
    measured = frame.agg(F.sum(row_bytes(frame)).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(frame) if measured <= limit else frame
