import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidestrata.config import PipelineConfig  # noqa: E402
from workload.compare import session  # noqa: E402

AS_OF = datetime(2024, 2, 1, 9, 30, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    spark = session()
    yield spark
    spark.stop()


@pytest.fixture
def databases(spark, tmp_path):
    """Fresh databases of one test: (silver, gold)."""
    stem = f"t{abs(hash(str(tmp_path)))}"
    names = []
    for layer in ("silver", "gold"):
        name = f"{stem}_{layer}"
        spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{layer}'")
        names.append(name)
    return names


@pytest.fixture
def cfg(databases):
    silver, gold = databases
    return PipelineConfig(
        silver_database=silver, gold_database=gold, regions=None, job_name="job", as_of=AS_OF
    )


def record(**changes):
    """A raw statistics record as CSV delivers it."""
    base = {
        "video_id": "v1",
        "trending_date": "17.14.11",
        "title": "a title",
        "channel_title": "a channel",
        "category_id": "10",
        "publish_time": "2017-11-13T17:13:01.000Z",
        "tags": "x|y",
        "views": "1000",
        "likes": "50",
        "dislikes": "5",
        "comment_count": "20",
        "thumbnail_link": "http://thumb",
        "comments_disabled": "False",
        "ratings_disabled": "False",
        "video_error_or_removed": "False",
        "description": "words",
        "region": "us",
    }
    return base | changes


@pytest.fixture
def raw(spark):
    def make(*changes):
        from tidestrata.schemas import CSV_SCHEMA

        return spark.createDataFrame([record(**c) for c in changes], CSV_SCHEMA)

    return make
