"""Column names and types that are part of the data model."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

STRING, LONG, FLAG = StringType(), LongType(), BooleanType()

# The cleaned statistics record, in storage order.
STATISTICS_TYPES = {
    "video_id": STRING,
    "trending_date": STRING,
    "title": STRING,
    "channel_title": STRING,
    "category_id": LONG,
    "publish_time": STRING,
    "tags": STRING,
    "views": LONG,
    "likes": LONG,
    "dislikes": LONG,
    "comment_count": LONG,
    "thumbnail_link": STRING,
    "comments_disabled": FLAG,
    "ratings_disabled": FLAG,
    "video_error_or_removed": FLAG,
    "description": STRING,
    "region": STRING,
}

# Where an API item keeps each statistics field.
API_FIELDS = {
    "video_id": "id",
    "title": "snippet.title",
    "channel_title": "snippet.channelTitle",
    "category_id": "snippet.categoryId",
    "publish_time": "snippet.publishedAt",
    "tags": "snippet.tags",
    "views": "statistics.viewCount",
    "likes": "statistics.likeCount",
    "dislikes": "statistics.dislikeCount",
    "comment_count": "statistics.commentCount",
    "thumbnail_link": "snippet.thumbnails.default.url",
    "description": "snippet.description",
}

# What an API item holds where the API no longer gives the field.
API_DEFAULTS = {
    "tags": None,
    "dislikes": 0,
    "thumbnail_link": None,
    "comments_disabled": False,
    "ratings_disabled": False,
    "video_error_or_removed": False,
}

# Names a category title may have, in order of preference.
CATEGORY_TITLE_NAMES = ("snippet.title", "snippet_title", "category_name", "title")

# The columns a category file is expected to give.
CATEGORY_REQUIRED = ("id", "snippet.title")

# Fixed value: the name given to a category without a title.
UNKNOWN = "Unknown"

# Fixed value: the region of a file outside any region folder.
UNKNOWN_REGION = "unknown"

COUNT_COLUMNS = ("views", "likes", "dislikes", "comment_count")
RECORD_KEY = ("video_id", "region", "trending_date_parsed")


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


# A CSV file arrives as text and is typed later, so that a bad value costs one field, not one row.
CSV_SCHEMA = StructType([StructField(name, STRING) for name in STATISTICS_TYPES])

VIDEO_ITEM = _struct(
    id=STRING,
    snippet=_struct(
        title=STRING,
        channelTitle=STRING,
        categoryId=STRING,
        publishedAt=STRING,
        tags=ArrayType(STRING),
        description=STRING,
        thumbnails=_struct(default=_struct(url=STRING)),
    ),
    statistics=_struct(
        viewCount=STRING, likeCount=STRING, dislikeCount=STRING, commentCount=STRING
    ),
)

LANDING_STAMP = _struct(
    ingestion_id=STRING,
    region=STRING,
    ingestion_timestamp=STRING,
    video_count=LONG,
    source=STRING,
)

API_DOCUMENT = _struct(
    items=ArrayType(VIDEO_ITEM), _pipeline_metadata=LANDING_STAMP, region=STRING, date=STRING,
    hour=STRING,
)

CATEGORY_ITEM = _struct(
    kind=STRING,
    etag=STRING,
    id=STRING,
    snippet=_struct(title=STRING, assignable=FLAG, channelId=STRING),
)

CHECK_RESULT = _struct(
    check=STRING,
    table=STRING,
    column=STRING,
    value=DoubleType(),
    threshold=DoubleType(),
    missing_columns=ArrayType(STRING),
    negative_count=LONG,
    extreme_count=LONG,
    latest_record=STRING,
    cutoff=STRING,
    passed=FLAG,
    message=STRING,
)
