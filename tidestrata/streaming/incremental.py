"""New files only: a checkpoint remembers what was read, a run takes what is there and stops.

What streams is the names of files. Each batch reads exactly the files it is given with the batch
readers, so files of any depth, header and spelling are read, and a file that no reader takes fails the
run by its name. A batch may be delivered twice after a failure. Merging statistics, replacing
category partitions and filing rejected input under its batch give the same tables then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidestrata.config import PipelineConfig
from tidestrata.plans.silver import load_categories, load_inputs
from tidestrata.sources import api_input, arriving_files, category_documents, csv_input
from tidestrata.sources.files import CSV_NAME, JSON_NAME, qualified, wanted_files
from tidestrata.workspace import shared_folder


def progress_folder(spark: SparkSession, table: str, source: str) -> str:
    return f"{shared_folder(spark)}/progress/{table.replace('.', '/')}/{source}"


def each_batch(
    files: DataFrame, load: Callable[[list[str], str], object], checkpoint: str
) -> StreamingQuery:
    """Run ``load`` on the names of each batch's files and the name of the batch, and wait for the end.

    A batch is named by its query, whose id lies in the checkpoint, and its number: another checkpoint
    never repeats a name. One name per new file reaches the driver, which plans their reading.
    """

    def batch(frame: DataFrame, number: int) -> None:
        stream = frame.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        load(sorted(row["path"] for row in frame.collect()), f"{stream}-{number}")

    query = (
        files.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def stream_statistics(
    spark: SparkSession,
    cfg: PipelineConfig,
    *,
    checkpoint: str | None = None,
    files_per_batch: int | None = None,
) -> list[StreamingQuery]:
    """Start one run over new raw statistics files, CSV first, and wait for each to finish."""
    kinds = {
        "csv": (cfg.csv_path, cfg.csv_layout, csv_input, CSV_NAME),
        "api": (cfg.api_path, cfg.api_layout, api_input, JSON_NAME),
    }
    queries = []
    for name, (path, layout, read, wanted) in kinds.items():
        if not path:
            continue
        root = qualified(spark, path)

        def load(files: list[str], batch: str, name=name, path=path, layout=layout, read=read, wanted=wanted, root=root):
            own = wanted_files(root, files, wanted, regions=cfg.regions)
            if own:
                rows = read(spark, path, layout=layout, files=own, regions=cfg.regions)
                load_inputs({name: rows}, cfg, f"{name}-{batch}")

        folder = (
            f"{checkpoint}/{name}" if checkpoint else progress_folder(spark, cfg.statistics, name)
        )
        queries.append(each_batch(arriving_files(spark, path, files_per_batch), load, folder))
    return queries


def stream_categories(
    spark: SparkSession,
    cfg: PipelineConfig,
    *,
    checkpoint: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start one run over new category files and wait for it to finish."""
    root = qualified(spark, cfg.category_path)

    def load(files: list[str], batch: str) -> None:
        own = wanted_files(root, files, JSON_NAME, region=False)
        if own:
            documents = category_documents(
                spark,
                cfg.category_path,
                layout=cfg.category_layout,
                item=cfg.category_schema,
                files=own,
            )
            load_categories(documents, cfg, f"categories-{batch}")

    folder = checkpoint or progress_folder(spark, cfg.reference, "categories")
    return each_batch(arriving_files(spark, cfg.category_path, files_per_batch), load, folder)
