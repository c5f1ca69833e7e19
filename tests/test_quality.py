from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF
from tidestrata.config import QualityRules
from tidestrata.operators.quality import check_table, check_tables, verdict
from tidestrata.schemas import CHECK_RESULT
from tidestrata.sinks import append
from tidestrata.sources import bounded_sample

def statistics(spark, rows=20, **columns):
    frame = spark.range(rows).select(
        F.concat(F.lit("v"), "id").alias("video_id"),
        F.lit("t").alias("title"),
        F.lit("c").alias("channel_title"),
        (F.col("id") * 10).alias("views"),
        F.lit("us").alias("region"),
        F.lit(AS_OF.isoformat()).cast("timestamp").alias("_processed_at"),
    )
    return frame.withColumns(columns) if columns else frame


def results(frame, name="clean_statistics", check=None, **rules):
    found = check_table(frame, name, QualityRules(**rules), AS_OF).collect()
    return [r for r in found if check in (None, r.check)]


def test_good_table_passes_with_one_row_per_check(spark):
    frame = check_table(statistics(spark), "clean_statistics", as_of=AS_OF)
    assert frame.schema.names == CHECK_RESULT.names
    rows = frame.collect()
    assert [r.check for r in rows] == ["row_count", *["null_pct"] * 5, "schema", "value_range", "freshness"]
    assert all(r.passed for r in rows)
    assert rows[0].message == "Row count: 20 (min: 10)"
    assert rows[1].message == "video_id null%: 0.00% (max: 5.0%)"
    assert rows[6].message == "All expected columns present" and rows[6].missing_columns == []
    assert rows[7].message == "Views: 0 negative, 0 extreme (>50,000,000,000)"
    assert rows[8].message == (
        "Latest: 2024-02-01 09:30:00+00:00, Cutoff: 2024-01-30 09:30:00+00:00"
    )


def test_it_is_one_pass(spark):
    plan = check_table(statistics(spark), "clean_statistics", as_of=AS_OF)._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("Aggregate") == 1


@pytest.mark.parametrize("rows, passed", [(9, False), (10, True)])
def test_row_count(spark, rows, passed):
    assert results(statistics(spark, rows), check="row_count")[0].passed is passed


@pytest.mark.parametrize("nulls, of, passed, value", [(5, 100, True, 5.0), (501, 10_000, False, 5.01)])
def test_null_share_is_inclusive(spark, nulls, of, passed, value):
    title = F.when(F.col("id") >= nulls, F.lit("t"))
    frame = spark.range(of).select(
        title.alias("title"), F.lit("v").alias("video_id"), F.lit("c").alias("channel_title"),
        F.lit(1).cast("long").alias("views"), F.lit("us").alias("region"),
    )
    row = results(frame, check="null_pct")[1]
    assert (row.column, row.passed, row.value) == ("title", passed, value)


def test_empty_text_is_not_missing_but_nan_is(spark):
    frame = spark.createDataFrame([("", float("nan")), ("", 1.0)], "a string, b double")
    rows = check_table(frame, "t", QualityRules(critical_columns={"t": ("a", "b")}), AS_OF, ["null_pct"])
    assert [(r.column, r.value) for r in rows.collect()] == [("a", 0.0), ("b", 50.0)]


def test_empty_table(spark):
    rows = results(statistics(spark, 0))
    assert {r.value for r in rows if r.check == "null_pct"} == {100.0}
    assert {r.check for r in rows if not r.passed} == {"row_count", "null_pct"}
    fresh = [r for r in rows if r.check == "freshness"][0]
    assert fresh.passed and "no parseable values" in fresh.message and fresh.cutoff is None


def test_missing_column_fails_twice(spark):
    rows = results(statistics(spark).drop("title"))
    failed = [r for r in rows if not r.passed]
    assert [(r.check, r.message) for r in failed] == [
        ("null_pct", "Column 'title' missing from table"),
        ("schema", "Missing columns: ['title']"),
    ]
    assert failed[1].missing_columns == ["title"]


def test_unconfigured_table_fails(spark):
    rows = results(statistics(spark), name="other")
    assert [(r.check, r.passed) for r in rows] == [
        ("row_count", True), ("null_pct", False), ("schema", False), ("freshness", True),
    ]
    assert rows[1].message.startswith("No critical columns configured for table 'other'")
    assert rows[2].message == "No expected columns configured for 'other'"


@pytest.mark.parametrize(
    "views, negative, extreme", [(50_000_000_000, 0, 0), (50_000_000_001, 0, 20), (-5, 20, 0)]
)
def test_value_range(spark, views, negative, extreme):
    row = results(statistics(spark, views=F.lit(views).cast("long")), check="value_range")[0]
    assert (row.negative_count, row.extreme_count) == (negative, extreme)
    assert row.passed is (negative == extreme == 0)


def test_value_range_ignores_text_that_is_no_number(spark):
    assert results(statistics(spark, views=F.lit("many")), check="value_range")[0].passed
    assert results(statistics(spark, views=F.lit("-1")), check="value_range")[0].negative_count == 20
    assert results(statistics(spark).drop("views"), check="value_range") == []


@pytest.mark.parametrize("late, passed", [(0, True), (1, False)])
def test_freshness_is_inclusive(spark, late, passed):
    made = AS_OF - timedelta(hours=48, seconds=late)
    stamp = F.lit(made.isoformat()).cast("timestamp")
    assert results(statistics(spark, _processed_at=stamp), check="freshness")[0].passed is passed


def test_freshness_from_text_and_without_time(spark):
    plain = statistics(spark).drop("_processed_at")
    assert results(plain, check="freshness")[0].message.startswith("No timestamp column found")
    for text, passed in (("2024-02-01T08:00:00.5", True), ("2023-01-01T00:00:00+00:00", False), ("junk", True)):
        row = results(plain.withColumn("_ingestion_timestamp", F.lit(text)), check="freshness")[0]
        assert row.passed is passed


def test_sample_limits_the_rows(spark):
    assert results(statistics(spark, 500), check="row_count", sample_rows=50)[0].value == 50


def test_unreadable_table_fails_and_others_are_checked(spark, databases):
    name = f"{databases[0]}.clean_statistics"
    append(statistics(spark), name)
    checks = check_tables(spark, {"clean_statistics": name, "gone": "no_such_table"}, as_of=AS_OF)
    row = verdict(checks).first()
    assert (row.quality_passed, row.checks_passed, row.checks_total) == (False, 9, 10)
    failed = [d for d in row.details if not d.passed]
    assert [(d.check, d.table) for d in failed] == [("read_table", "gone")]


def test_table_whose_files_are_lost_fails(spark, databases, tmp_path):
    name = f"{databases[0]}.clean_statistics"
    append(statistics(spark), name)
    for file in (tmp_path / "silver").rglob("*.parquet"):
        file.write_bytes(b"not parquet")
    rows = check_tables(spark, {"clean_statistics": name}, as_of=AS_OF).collect()
    assert [(r.check, r.passed) for r in rows] == [("read_table", False)]


def test_schema_check_reads_no_rows(spark):
    unread = spark.range(10).select(F.raise_error(F.lit("read")).alias("id"), F.lit("a").alias("region"))
    found = check_table(unread, "reference_data", as_of=AS_OF, checks=["schema"]).collect()
    assert [r.passed for r in found] == [True]


def test_a_sample_by_key_is_the_same_however_rows_lie(spark):
    frame = spark.range(3000).selectExpr("id", "IF(id % 3 = 0, NULL, id) AS v")
    picked = [
        sorted(r.id for r in bounded_sample(f, 100, ["id"]).collect())
        for f in (frame, frame.repartition(7), frame.orderBy(F.col("id").desc()))
    ]
    assert picked[0] == picked[1] == picked[2] and len(picked[0]) == 100
    assert 15 < sum(i % 3 == 0 for i in picked[0]) < 55
