from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidestrata.functions import (
    day_of_trend,
    exact_mean,
    flag,
    instant,
    iso_text,
    per_hundred_views,
    region_of_path,
    trend_text,
    whole_number,
)


def values(spark, inputs, kind, make):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(make(F.col("v"))).collect()]


def test_whole_number_cuts_fractions_and_nulls_bad_text(spark):
    texts = ["12", " 12 ", "12.7", "-3.9", "12.", "abc", "", None, "9007199254740993.5", "1e3"]
    got = values(spark, texts, "string", whole_number)
    assert got == [12, 12, 12, -3, 12, None, None, None, 9007199254740993, None]


def test_flag(spark):
    texts = ["True", "FALSE", "x", None]
    assert values(spark, texts, "string", flag) == [True, False, None, None]


def test_day_of_trend_takes_both_forms(spark):
    texts = ["17.14.11", "2017-11-14", "17.14.13", "junk", None, "2017-11-14 05:00:00"]
    day = date(2017, 11, 14)
    assert values(spark, texts, "string", day_of_trend) == [day, day, None, None, None, day]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_instants_are_shown_in_utc(spark, zone):
    tokyo = datetime(2024, 2, 1, 8, 0, tzinfo=timezone(timedelta(hours=9)))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.range(1).select(
            iso_text(instant(tokyo)).alias("whole"),
            iso_text(instant(tokyo.replace(microsecond=120))).alias("fraction"),
            trend_text(instant(tokyo)).alias("trend"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.whole == "2024-01-31T23:00:00+00:00"
    assert row.fraction == "2024-01-31T23:00:00.000120+00:00"
    assert row.trend == "24.31.01"


def test_rates_are_zero_without_views(spark):
    frame = spark.createDataFrame(
        [(1, 3, 7), (0, 3, 7), (-5, 3, 7), (3, 1, 0)], "views long, a long, b long"
    )
    rate = per_hundred_views(F.col("a"), F.col("b"), views=F.col("views"))
    assert [r[0] for r in frame.select(rate).collect()] == [1000.0, 0.0, 0.0, 33.3333]


def test_exact_mean_does_not_depend_on_order(spark):
    frame = spark.range(5000).select((F.col("id") % 97 / 7).alias("x"))
    rated = frame.select(F.round("x", 4).alias("x"))
    means = {
        rated.repartition(n).agg(exact_mean(F.col("x"))).first()[0] for n in (1, 3, 8)
    }
    assert len(means) == 1


def test_exact_mean_holds_extreme_rates(spark):
    biggest = float(2**63) * 100
    frame = spark.createDataFrame([(biggest,), (biggest,)], "x double")
    assert frame.agg(exact_mean(F.col("x"))).first()[0] == pytest.approx(biggest)


def test_region_of_path(spark):
    paths = [
        "s3://b/x/region=us/date=2024-01-01/a.json",
        "b/region%3Dus/a.json",
        "a/x.json",
        "region=US/region=ca/a",
        "a/myregion=us/x",
        "a/region=/x",
        "a/region=a=b/x",
        "a/region=new+york/x",
        "a/100%/region=us/x",
    ]
    got = values(spark, paths, "string", region_of_path)
    assert got == ["us", "us", "unknown", "US", "unknown", "unknown", "a", "new york", "us"]
