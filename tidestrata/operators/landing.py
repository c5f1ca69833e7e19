"""Landing API payloads: stamping them, and the manifest of what arrived.

Payloads come as rows of (region, kind, payload, error): ``kind`` is ``trending`` or
``categories``, ``payload`` the JSON text, ``error`` the reason if it could not be fetched.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestrata.functions import instant, iso_text, plain_region, utc_text
from tidestrata.operators.bounds import broadcast_if_small

TRENDING, CATEGORIES = "trending", "categories"

# Text forms of the run instant in folder names and ids.
DATE_FORMAT, HOUR_FORMAT, ID_FORMAT = "yyyy-MM-dd", "HH", "yyyyMMdd_HHmmss"

NOT_JSON = "payload is not a JSON object"


def item_count(payload: Column) -> Column:
    """The number of entries in ``items``, 0 without a list."""
    return F.coalesce(F.json_array_length(F.get_json_object(payload, "$.items")), F.lit(0))


def on_one_line(payload: Column) -> Column:
    """The document without its line breaks, which JSON only allows between its parts."""
    return F.trim(F.regexp_replace(payload, r"[\r\n]+\s*", ""))


def is_object(payload: Column) -> Column:
    """Whether a text is one JSON object and nothing else.

    The text as it came is parsed as the only element of an array: broken or trailing text breaks
    the array, and a second document is a second element. Repeated fields are allowed, as readers
    allow them, and no length is too long.
    """
    parsed = F.from_json(F.concat(F.lit("["), payload, F.lit("]")), "array<struct<items string>>")
    return F.coalesce((F.size(parsed) == 1) & F.get(parsed, F.lit(0)).isNotNull(), F.lit(False))


def assessed(payloads: DataFrame) -> DataFrame:
    """Payloads with plain region, document on one line, its item count, and any problem."""
    if "error" not in payloads.columns:
        payloads = payloads.withColumn("error", F.lit(None).cast("string"))
    document = on_one_line(F.col("payload"))
    return payloads.select(
        plain_region(F.col("region")).alias("region"),
        "kind",
        document.alias("document"),
        item_count(document).cast("bigint").alias("item_count"),
        F.coalesce("error", F.when(~is_object(F.col("payload")), F.lit(NOT_JSON))).alias(
            "problem"
        ),
    )


def by_kind(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trending payloads, and the category payloads a run gets to.

    A region whose trending payload failed skips its categories. The trending payloads, which
    are the many, are not joined for it; their failed regions are.
    """
    trending = payloads.where(F.col("kind") == TRENDING)
    failed = trending.where(F.col("problem").isNotNull()).select("region").distinct()
    categories = payloads.where(F.col("kind") == CATEGORIES)
    return trending, categories.join(broadcast_if_small(failed), "region", "left_anti")


def stamped_documents(payloads: DataFrame, source: str, as_of: datetime | None) -> DataFrame:
    """Good payloads with ``_pipeline_metadata`` as their last field, and their folders.

    The stamp is added to the text, so the payload's own fields stay exactly as they came.
    """
    now = instant(as_of)
    stamp = F.to_json(
        F.struct(
            utc_text(now, ID_FORMAT).alias("ingestion_id"),
            "region",
            iso_text(now).alias("ingestion_timestamp"),
            F.when(F.col("kind") == TRENDING, F.col("item_count")).alias("video_count"),
            F.lit(source).alias("source"),
        )
    )
    body = F.rtrim(F.regexp_replace("document", r"\}\s*$", ""))
    comma = F.when(body.endswith("{"), F.lit("")).otherwise(F.lit(","))
    return payloads.where(F.col("problem").isNull()).select(
        "region",
        utc_text(now, DATE_FORMAT).alias("date"),
        utc_text(now, HOUR_FORMAT).alias("hour"),
        F.concat(body, comma, F.lit('"_pipeline_metadata":'), stamp, F.lit("}")).alias("value"),
    )


def manifest(payloads: DataFrame, as_of: datetime | None) -> DataFrame:
    """Per region and kind: landed or failed, with the number of items or the problem."""
    return (
        payloads.groupBy("region", "kind")
        .agg(
            F.count(F.lit(1)).alias("documents"),
            F.count("problem").alias("failed_documents"),
            F.try_sum(F.when(F.col("problem").isNull(), F.col("item_count"))).alias("item_count"),
            F.min("problem").alias("error"),
        )
        .select(
            utc_text(instant(as_of), ID_FORMAT).alias("ingestion_id"),
            "region",
            "kind",
            F.when(F.col("failed_documents") == 0, "success").otherwise("failed").alias("status"),
            "documents",
            F.coalesce("item_count", F.lit(0)).alias("item_count"),
            "error",
        )
    )
