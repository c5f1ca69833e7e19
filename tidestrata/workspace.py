"""The shared folder for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"
#: Spark's setting to remove a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where nothing is set and the session is local, as in tests, a fresh temporary folder stands
    in; on a cluster each machine would have its own.
    """
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidestrata-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_folder(spark: SparkSession, kind: str) -> str:
    """A fresh path in the shared folder, deleted when the session ends."""
    folder = f"{shared_folder(spark)}/{kind}/{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What a write in here has shuffled is removed when it is done.

    Otherwise shuffle files lie on the executors' disks until the driver happens to collect its garbage,
    so a job of several writes would hold the rows once for each of them.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)


def prepare_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping a folder that is set already."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
