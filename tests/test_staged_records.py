from pyspark.sql import functions as F

import workload.facts
import workload.queries
from workload.compare import TESTDATA

FOLDER = f"{TESTDATA}/sf0.001"


def counting(spark, monkeypatch):
    """Make every build of the raw records count the rows it computes."""
    counter = spark.sparkContext.accumulator(0)
    original = workload.facts.appearances

    @F.udf("boolean")
    def seen(_):
        counter.add(1)
        return True

    def appearances(spark, folder):
        return original(spark, folder).where(seen(F.col("video_id")))

    monkeypatch.setattr(workload.facts, "appearances", appearances)
    monkeypatch.setattr(workload.queries, "appearances", appearances)
    return counter, original(spark, FOLDER).count()


def test_append_vs_merge_joins_the_records_once(spark, monkeypatch):
    counter, rows = counting(spark, monkeypatch)
    result = {
        (r["mode"], r["region"]): r["records"]
        for r in workload.queries.QUERIES["append_vs_merge"](spark, FOLDER).collect()
    }
    assert counter.value < 2 * rows
    assert sum(n for (mode, _), n in result.items() if mode == "append") == 2 * sum(
        n for (mode, _), n in result.items() if mode == "merge"
    )


def test_incremental_gold_joins_the_records_once(spark, monkeypatch):
    counter, rows = counting(spark, monkeypatch)
    result = workload.queries.QUERIES["incremental_gold"](spark, FOLDER).collect()
    assert counter.value < 2 * rows
    assert result and all(r["days_first"] > 0 for r in result)


def test_incremental_any_file_joins_the_records_once(spark, monkeypatch):
    counter, rows = counting(spark, monkeypatch)
    result = workload.queries.QUERIES["incremental_any_file"](spark, FOLDER).collect()
    assert counter.value < 2 * rows
    assert result


def test_refreshed_days_joins_the_records_once(spark, monkeypatch):
    counter, rows = counting(spark, monkeypatch)
    result = workload.queries.QUERIES["refreshed_days"](spark, FOLDER).collect()
    assert counter.value < 2 * rows
    assert result


def test_incremental_silver_joins_the_records_once(spark, monkeypatch):
    counter, rows = counting(spark, monkeypatch)
    result = workload.queries.QUERIES["incremental_silver"](spark, FOLDER).collect()
    assert counter.value < 2 * rows
    assert result


def test_append_redelivered_joins_the_records_once(spark, monkeypatch):
    counter, rows = counting(spark, monkeypatch)
    result = workload.queries.QUERIES["append_redelivered"](spark, FOLDER).collect()
    assert counter.value < 2 * rows
    assert result


def test_empty_input_joins_the_records_once(spark, monkeypatch):
    counter, rows = counting(spark, monkeypatch)
    result = workload.queries.QUERIES["empty_input"](spark, FOLDER).collect()
    assert counter.value < 2 * rows
    assert all(r["second_read"] == 0 for r in result)


def test_source_files_complete_joins_the_records_once(spark, monkeypatch):
    counter, rows = counting(spark, monkeypatch)
    result = workload.queries.QUERIES["source_files_complete"](spark, FOLDER).collect()
    assert counter.value < 2 * rows
    assert len(result) == rows
