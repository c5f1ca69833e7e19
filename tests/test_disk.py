"""What loads leave and move on disk; rows are those of the other tests."""

import glob
import os
from datetime import date

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import tidestrata.plans.silver as silver
import workload.queries
from conftest import AS_OF
from tidestrata.operators.partials import DAY
from tidestrata.plans import clean_statistics, load_statistics
from tidestrata.sinks import append
from tidestrata.sinks.merge import only_partitions, stored
from tidestrata.sources import table
from tidestrata.workspace import CLEANUP
from workload.compare import TESTDATA
from workload.queries import MANY_FILES, QUERIES

FOLDER = f"{TESTDATA}/sf0.001"


def shuffle_files(spark) -> set[str]:
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    return {f for folder in folders for f in glob.glob(f"{folder.getPath()}/*/shuffle_*.data")}


def plan_of(frame: DataFrame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_writes_leave_no_shuffle_files(spark, databases, tmp_path):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP, None)
    rows = spark.range(200_000).select("id", (F.col("id") % 3).cast("string").alias("region"))
    kept = stored(rows.repartition(4, "id"), str(tmp_path / "kept"))
    for _ in range(2):
        append(kept, f"{databases[0]}.rows")
    assert table(spark, f"{databases[0]}.rows").groupBy("region").count().count() == 3
    assert kept.count() == 200_000 and table(spark, f"{databases[0]}.rows").count() == 400_000
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    # Those of the counts hold a few rows.
    left = {f for f in shuffle_files(spark) - before if os.path.getsize(f) > 5000}
    assert not left
    assert spark.conf.get(CLEANUP, None) == setting


@pytest.mark.parametrize("mode", ["append", "merge"])
def test_rates_are_not_staged_and_are_in_the_table(spark, raw, cfg, mode, monkeypatch):
    from dataclasses import replace

    cfg, staged = replace(cfg, statistics_mode=mode), []

    def watched(frame, path):
        staged.append(frame.columns)
        return stored(frame, path)

    monkeypatch.setattr(silver, "stored", watched)
    lots = [raw({"video_id": "a", "views": "0"}, {"video_id": "b"}), raw({"video_id": "b", "views": "2000"})]
    for lot in lots:
        load_statistics(lot, cfg)
    assert staged and not any({"like_ratio", "engagement_rate"} & set(columns) for columns in staged)
    written = table(spark, cfg.statistics)
    shown = sorted(tuple(r) for r in written.select("video_id", "views", "like_ratio", "engagement_rate").collect())
    again = {"append": [("b", 1000, 5.0, 7.5)], "merge": []}[mode]
    assert shown == [("a", 0, 0.0, 0.0), *again, ("b", 2000, 2.5, 3.75)]
    expected = [c for c in clean_statistics(lots[0], "job", AS_OF).columns if c not in cfg.statistics_partitions]
    assert written.columns == [*expected, *cfg.statistics_partitions]


def test_staged_rows_and_tables_are_zstd_parquet(spark, raw, cfg, databases):
    load_statistics(raw({"video_id": "a"}), cfg)
    files = table(spark, cfg.statistics).inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_rates_are_derived_after_the_newest_record_is_picked(spark, raw):
    plan = plan_of(clean_statistics(raw({"video_id": "a"}, {"video_id": "a", "likes": "9"}), "job", AS_OF))
    above, exchange, below = plan.partition("Exchange hashpartitioning(video_id")
    assert exchange and "like_ratio" in above and "like_ratio" not in below and "engagement_rate" not in below


def test_partitions_are_picked_without_a_shuffle_of_the_rows(spark):
    days = [("us", date(2024, 1, d), f"v{d}") for d in (1, 2, 3)] + [("ca", date(2024, 1, 1), "c"), (None, None, "n")]
    frame = spark.createDataFrame(days, "region string, trending_date_parsed date, video_id string")
    touched = spark.createDataFrame([days[0][:2], days[2][:2], (None, None)], "region string, trending_date_parsed date")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        picked = only_partitions(frame, touched, DAY)
        assert "SortMergeJoin" not in plan_of(picked)
        assert sorted(r["video_id"] for r in picked.collect()) == ["n", "v1", "v3"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("name", ["gated_gold", "blocked_gate", "incremental_silver", "incremental_any_file"])
def test_raw_csv_files_are_compressed(spark, name, monkeypatch):
    original, folders = workload.queries.fresh_folder, []

    def fresh_folder(spark, kind):
        folders.append(original(spark, kind))
        return folders[-1]

    monkeypatch.setattr(workload.queries, "fresh_folder", fresh_folder)
    assert QUERIES[name](spark, FOLDER).count() > 0
    paths = [f.removeprefix("file:") for f in folders]
    files = [f for p in paths for f in glob.glob(f"{p}/**/part-*", recursive=True) if ".csv" in f.lower()]
    assert files and all(f.lower().endswith(".csv.gz") for f in files)
    if name == "incremental_any_file":
        assert any(f.endswith(".CSV.gz") for f in files)


def test_rejected_input_joins_the_records_once(spark, monkeypatch):
    from test_staged_records import counting

    counter, rows = counting(spark, monkeypatch)
    result = QUERIES["rejected_input"](spark, FOLDER).collect()
    assert counter.value < 2 * rows
    assert result and all(r["rows_rejected"] > 0 for r in result)


def test_documents_of_many_files_are_moved_by_their_tasks(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    original, seen = DataFrameWriter.options, []

    def options(self, **given):
        seen.append(given)
        return original(self, **given)

    monkeypatch.setattr(DataFrameWriter, "options", options)
    assert QUERIES["api_documents_layout"](spark, FOLDER).count() > 0
    assert any(MANY_FILES.items() <= given.items() and given.get("maxRecordsPerFile") == 1 for given in seen)
