from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import AS_OF, record
from tidestrata.operators.cleanse import cleansed
from tidestrata.operators.conform import from_api, from_csv, is_api_layout, statistics_record
from tidestrata.operators.counts import run_counts
from tidestrata.operators.latest import latest_records
from tidestrata.plans import clean_statistics
from tidestrata.schemas import CSV_SCHEMA, STATISTICS_TYPES
from tidestrata.sources import api_statistics, csv_statistics, keep_regions


def clean(frame):
    return clean_statistics(from_csv(frame), "job", AS_OF)


def test_cleaned_record(raw):
    row = clean(raw({"region": " US "})).first()
    assert row.region == "us" and row.trending_date_parsed == date(2017, 11, 14)
    assert (row.like_ratio, row.engagement_rate) == (5.0, 7.5)
    assert row._job_name == "job" and row.category_id == 10 and row.comments_disabled is False


def test_bad_fields_cost_one_field(raw):
    row = clean(raw({"views": "abc", "likes": None, "category_id": "x", "comments_disabled": "?"})).first()
    assert (row.views, row.likes, row.category_id, row.comments_disabled) == (0, 0, None, None)
    assert (row.like_ratio, row.engagement_rate) == (0.0, 0.0)


def test_rows_without_id_are_dropped(raw):
    assert clean(raw({"video_id": None}, {})).count() == 1


def test_one_record_per_key_by_stored_values(raw):
    frame = raw({"likes": "1"}, {"likes": "9"}, {"likes": "5"}, {"trending_date": "17.15.11"})
    kept = clean(frame).orderBy("trending_date_parsed").collect()
    assert [r.likes for r in kept] == [9, 50]


def test_a_later_run_wins_over_larger_values(raw):
    old = clean_statistics(from_csv(raw({"likes": "900"})), "job", AS_OF.replace(hour=1))
    new = clean_statistics(from_csv(raw({"likes": "1"})), "job", AS_OF)
    assert [r.likes for r in latest_records(old.unionByName(new)).collect()] == [1]


def test_records_without_a_day_are_one_group(raw):
    assert clean(raw({"trending_date": "junk"}, {"trending_date": None})).count() == 1


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["v1", "v2", None]),
            st.sampled_from(["us", " US", "ca"]),
            st.sampled_from(["17.14.11", "2017-11-14", "bad"]),
            st.integers(-5, 5),
        ),
        min_size=1,
        max_size=25,
    )
)
def test_dedup_is_idempotent_and_keeps_every_key(spark, rows):
    raw = spark.createDataFrame(
        [record(video_id=v, region=r, trending_date=d, views=str(n)) for v, r, d, n in rows],
        CSV_SCHEMA,
    )
    once = clean(raw)
    key = ["video_id", "region", "trending_date_parsed"]
    expected = cleansed(from_csv(raw)).select(*key).distinct()
    assert sorted(map(str, once.select(*key).collect())) == sorted(map(str, expected.collect()))
    again = latest_records(once)
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))


def test_a_hot_key_is_limited_before_the_shuffle(raw):
    plan = clean(raw({}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_counts_of_a_run(raw):
    frame = from_csv(raw({}, {}, {"video_id": None}, {"video_id": "v2", "views": "-5", "title": None}))
    row = run_counts(frame, clean_statistics(frame, "job", AS_OF)).first()
    assert (row.rows_read, row.rows_kept, row.rows_removed) == (4, 2, 2)
    assert (row.raw_null_video_id, row.null_video_id, row.null_title) == (1, 0, 1)
    assert row.negative_views == 1


# --- files ----------------------------------------------------------------------------------

API_DOCUMENT = """{
  "kind": "list",
  "items": [
    {"id": "a1", "contentDetails": {"duration": "PT1M"},
     "snippet": {"title": "one", "channelTitle": "ch", "categoryId": "24",
                 "publishedAt": "2024-01-31T00:00:00Z", "tags": ["a", "b"],
                 "description": "d",
                 "thumbnails": {"default": {"url": "http://t"}}},
     "statistics": {"viewCount": "100", "likeCount": "7", "commentCount": "3"}},
    {"id": "a2", "snippet": {"title": "two", "channelTitle": "ch", "categoryId": "24",
                             "publishedAt": "2024-01-31T00:00:00Z", "description": "d"},
     "statistics": {"viewCount": "0"}}
  ]
}"""


@pytest.fixture
def bronze(tmp_path):
    """CSV and API files in one folder, as both uploads and landing leave them."""
    root = tmp_path / "raw_statistics"
    us = root / "region=us"
    landed = us / "date=2024-01-31" / "hour=09"
    landed.mkdir(parents=True)
    header = ",".join(c for c in STATISTICS_TYPES if c != "region")
    first = 'v1,17.14.11,"a ""quoted"", title",ch,1,t,x,10,1,0,0,l,False,True,False,"two\nlines"'
    (us / "USvideos.csv").write_text(f"{header}\n{first}\n")
    german = root / "region=de"
    german.mkdir()
    (german / "DEvideos.csv").write_text(f"{header}\n{first}\n{first.replace('v1', 'v2')}\n")
    (landed / "20240131_090000.json").write_text(API_DOCUMENT)
    return str(root)


def test_csv_source(spark, bronze):
    rows = from_csv(csv_statistics(spark, bronze)).orderBy("region", "video_id").collect()
    assert [(r.region, r.video_id) for r in rows] == [("de", "v1"), ("de", "v2"), ("us", "v1")]
    assert rows[0].title == 'a "quoted", title' and rows[0].description == "two\nlines"
    assert rows[0].ratings_disabled is True and rows[0].views == 10


def test_regions_are_pruned_partitions(spark, bronze):
    frame = keep_regions(csv_statistics(spark, bronze), ("us",))
    assert frame.count() == 1
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan
    assert keep_regions(csv_statistics(spark, bronze), ("US",)).count() == 0


def test_api_source(spark, bronze):
    items = api_statistics(spark, bronze)
    assert is_api_layout(items)
    one, two = statistics_record(items, AS_OF).orderBy("video_id").collect()
    assert (one.tags, one.thumbnail_link, one.views, one.trending_date) == ("a|b", "http://t", 100, "24.01.02")
    assert (two.tags, two.likes, two.region, two.comments_disabled) == (None, None, "us", False)
    filled = clean_statistics(statistics_record(items, AS_OF), "job", AS_OF)
    assert {r.video_id: r.dislikes for r in filled.collect()} == {"a1": 0, "a2": 0}
    assert {str(r.trending_date_parsed) for r in filled.collect()} == {"2024-02-01"}


def test_underscore_names_work_like_dotted_ones(spark, bronze):
    items = api_statistics(spark, bronze)
    renamed = items.toDF(*[c.replace(".", "__") for c in items.columns])
    assert is_api_layout(renamed)
    assert from_api(renamed, AS_OF).exceptAll(from_api(items, AS_OF)).isEmpty()


def test_api_fields_that_may_be_absent(spark, bronze):
    items = api_statistics(spark, bronze)
    bare = items.drop("`snippet.tags`", "`statistics.dislikeCount`", "`snippet.thumbnails.default.url`")
    bare = bare.select(*[F.col(f"`{c}`") for c in bare.columns if c not in (
        "snippet.tags", "statistics.dislikeCount", "snippet.thumbnails.default.url")])
    row = from_api(bare, AS_OF).first()
    assert (row.tags, row.dislikes, row.thumbnail_link) == (None, 0, None)
    with pytest.raises(ValueError, match="views"):
        from_api(bare.drop("statistics.viewCount").select("id", "`snippet.title`",
            "`snippet.channelTitle`", "`snippet.categoryId`", "`snippet.publishedAt`", "region"), AS_OF)


def test_unknown_layout_is_refused(spark, bronze):
    with pytest.raises(ValueError, match="layout"):
        api_statistics(spark, bronze, layout="pages")
