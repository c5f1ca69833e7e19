"""Cleansing of statistics records: all narrow, so it runs inside the scan's stage."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestrata.functions import day_of_trend, instant, per_hundred_views, plain_region
from tidestrata.schemas import COUNT_COLUMNS

#: The columns ``with_rates`` derives from the counts.
RATES = ("like_ratio", "engagement_rate")


def with_key(frame: DataFrame) -> DataFrame:
    return frame.where(F.col("video_id").isNotNull())


def with_plain_region(frame: DataFrame) -> DataFrame:
    return frame.withColumn("region", plain_region(F.col("region")))


def with_day(frame: DataFrame) -> DataFrame:
    return frame.withColumn("trending_date_parsed", day_of_trend(F.col("trending_date")))


def with_counts(frame: DataFrame) -> DataFrame:
    """Missing counts become 0."""
    return frame.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in COUNT_COLUMNS})


def with_rates(frame: DataFrame) -> DataFrame:
    views, likes, dislikes, comments = (F.col(c) for c in COUNT_COLUMNS)
    return frame.withColumns(
        {
            "like_ratio": per_hundred_views(likes, views=views),
            "engagement_rate": per_hundred_views(likes, dislikes, comments, views=views),
        }
    )


def stamped(frame: DataFrame, job_name: str, as_of: datetime | None = None) -> DataFrame:
    return frame.withColumns({"_processed_at": instant(as_of), "_job_name": F.lit(job_name)})


def keyed(frame: DataFrame) -> DataFrame:
    """Keyed records with plain regions, real dates and filled counts."""
    for step in (with_key, with_plain_region, with_day, with_counts):
        frame = step(frame)
    return frame


def cleansed(frame: DataFrame) -> DataFrame:
    """``keyed`` records with rates."""
    return with_rates(keyed(frame))
