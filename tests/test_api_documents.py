from pyspark.sql import functions as F

from workload.facts import ITEM_FIELDS, api_documents, row_items


def test_items_built_after_grouping_equal_items_grouped(spark):
    rows = [
        ("v1", "t1", "c1", 10, "2024-01-01", 5, 3, 1, "r"),
        ("v2", "t2", "c1", 10, "2024-01-02", 0, None, 2, "r"),
        ("v3", None, None, None, None, None, None, None, "r"),
        ("v4", "t4", None, 11, "2024-01-03", 7, 1, 0, "s"),
    ]
    schema = (
        "video_id string, title string, channel_title string, category_id bigint, "
        "publish_time string, views bigint, likes bigint, comment_count bigint, region string"
    )
    frame = spark.createDataFrame(rows, schema).coalesce(1)
    items = api_documents(frame).withColumn("channel", F.col("items")[0]["snippet"]["channelTitle"])
    before = items.groupBy("region", "channel").agg(F.flatten(F.collect_list("items")).alias("items"))
    gathered = frame.select(
        "region", F.col("channel_title").alias("channel"), F.struct(*ITEM_FIELDS).alias("row")
    ).groupBy("region", "channel").agg(F.collect_list("row").alias("rows"))
    after = gathered.select(
        "region",
        "channel",
        F.flatten(F.transform("rows", lambda row: row_items(lambda name: row[name]))).alias("items"),
    )
    text = F.to_json(F.struct("items"), {"pretty": "true"})
    expected = sorted(before.select("region", "channel", text.alias("t")).collect(), key=str)
    assert sorted(after.select("region", "channel", text.alias("t")).collect(), key=str) == expected
    assert len(expected) == 3 and sum(r["t"].count('"id"') for r in expected) == 6
