"""Small helpers of several operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestrata.sinks.merge import discard
from tidestrata.workspace import CLEANUP, shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh path in the shared folder, deleted when the session ends."""
    path = f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stored(frame: DataFrame, kind: str) -> DataFrame:
    """``frame`` written to the shared folder and read back.

    Later steps, and tasks repeated after a lost executor, read the files and compute nothing again.
    """
    path = new_folder(frame.sparkSession, kind)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


#: Spark's setting for the rows Python gets at a time.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def staged(frame: DataFrame, kind: str, arrow_rows: int | None = None) -> DataFrame:
    """As `stored`; what the write has shuffled is removed when it is done.

    For operators of many steps, whose shuffle files would otherwise lie on the executors' disks until
    the driver forgets the steps. Steps that give whole texts to Python pass ``arrow_rows``, so that
    few long ones are in memory at a time.
    """
    settings = frame.sparkSession.conf
    own = {CLEANUP: "true"} | ({ARROW_ROWS: str(arrow_rows)} if arrow_rows else {})
    before = {name: settings.get(name, None) for name in own}
    for name, value in own.items():
        settings.set(name, value)
    try:
        return stored(frame, kind)
    finally:
        for name, value in before.items():
            settings.set(name, value) if value is not None else settings.unset(name)


def dropped(*frames: DataFrame) -> None:
    """Delete stored tables that are not read again."""
    for frame in frames:
        for file in frame.inputFiles()[:1]:
            discard(frame.sparkSession, file.rpartition("/")[0])


def unused(frame: DataFrame, name: str) -> str:
    """``name``, or a variant of it that ``frame`` has no column of."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
