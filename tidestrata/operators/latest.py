"""One record per key.

``row_number() <= 1`` is planned with a group limit before the shuffle: each task sends at most
one record per key, so a key that holds a third of all rows costs its reducer one record per
task, not a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidestrata.schemas import RECORD_KEY

# The newest run first. Records of one run then compare on their stored values, so the
# survivor does not depend on task timing, and a later merge picks the same one.
NEWEST_FIRST = (
    "_processed_at",
    "publish_time",
    "views",
    "likes",
    "dislikes",
    "comment_count",
    "title",
    "channel_title",
    "category_id",
    "comments_disabled",
    "ratings_disabled",
    "video_error_or_removed",
    "tags",
    "thumbnail_link",
    "description",
    "trending_date",
    "_job_name",
)

POSITION = "_position"


def first_per_key(frame: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*key).orderBy(*order)
    placed = frame.withColumn(POSITION, F.row_number().over(window))
    return placed.where(F.col(POSITION) == 1).drop(POSITION)


def latest_records(frame: DataFrame, key: Sequence[str] = RECORD_KEY) -> DataFrame:
    """The newest record per video, region and trending day."""
    order = [F.col(c).desc() for c in NEWEST_FIRST if c in frame.columns and c not in key]
    return first_per_key(frame, key, order)
