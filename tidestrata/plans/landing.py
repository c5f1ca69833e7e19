"""Landing fetched API payloads in the raw layer."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tidestrata.config import PipelineConfig
from tidestrata.operators.landing import assessed, by_kind, manifest, stamped_documents
from tidestrata.sinks.merge import discard, stored
from tidestrata.sinks.tables import PER_PARTITION, spread
from tidestrata.sources import table
from tidestrata.workspace import scratch_folder

# The raw folders.
TRENDING_FOLDER = "raw_statistics"
CATEGORIES_FOLDER = "raw_statistics_reference_data"


def land_raw(
    payloads: DataFrame,
    path: str,
    source: str,
    as_of: datetime | None = None,
    compression: str | None = None,
) -> DataFrame:
    """Write good payloads, one document per line, and give the manifest of all of them.

    Trending documents are added under ``region=/date=/hour=``; category documents replace those
    of the same region and day. One document per line lets Spark pack many into a file and split
    it when reading; read them back with ``layout="lines"``.

    The payloads are read and judged once, into the shared folder; what follows reads columns of
    that. Folders, stamps and manifest all have the instant at which the run began.

    ``compression`` names a codec of Spark's text sink, such as ``gzip``: JSON text is many times
    the size of its columns, and the readers take compressed files by their ending.
    """
    as_of = as_of or datetime.now(timezone.utc)
    spark = payloads.sparkSession
    folder = scratch_folder(spark, "landing")
    staged = stored(assessed(payloads), f"{folder}/assessed")
    trending, categories = by_kind(staged)

    options = {"compression": compression} if compression else {}
    folders = ["region", "date", "hour"]
    spread(stamped_documents(trending, source, as_of), folders).write.mode("append").options(
        **options
    ).partitionBy(
        *folders
    ).text(f"{path}/{TRENDING_FOLDER}")

    folders = ["region", "date"]
    stamped = stamped_documents(categories, source, as_of).drop("hour")
    spread(stamped, folders).write.mode("overwrite").options(**PER_PARTITION, **options).partitionBy(
        *folders
    ).text(f"{path}/{CATEGORIES_FOLDER}")
    result = manifest(trending.unionByName(categories.select(trending.columns)), as_of)
    result = stored(result.coalesce(1), f"{folder}/manifest")
    discard(spark, f"{folder}/assessed")
    return result


def land(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Land the fetched payloads of ``cfg.payload_table`` under ``cfg.landing_path``."""
    if not (cfg.payload_table and cfg.landing_path):
        raise ValueError("name a payload_table and a landing_path")
    return land_raw(table(spark, cfg.payload_table), cfg.landing_path, cfg.landing_source, cfg.as_of)
