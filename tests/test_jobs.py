import json
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, record
from tidestrata.config import QualityRules
from tidestrata.operators.conform import statistics_record
from tidestrata.plans import (
    bronze_to_silver,
    land_raw,
    load_statistics,
    reference_to_silver,
    run_pipeline,
    silver_to_gold,
)
from tidestrata.operators.conform import from_csv
from tidestrata.schemas import STATISTICS_TYPES
from tidestrata.sinks import append
from tidestrata.sources import api_statistics, category_documents, table
from tidestrata.streaming import stream_categories, stream_statistics

BUSINESS = ["video_id", "region", "trending_date_parsed", "views", "likes", "like_ratio"]


def write_csv(folder, region, name, *changes):
    place = folder / "stats" / f"region={region}"
    place.mkdir(parents=True, exist_ok=True)
    columns = [c for c in STATISTICS_TYPES if c != "region"]
    lines = [",".join(columns)]
    lines += [",".join(str(record(**c)[k] or "") for k in columns) for c in changes]
    (place / name).write_text("\n".join(lines) + "\n")
    return str(folder / "stats")


def write_categories(folder, region, *titles):
    place = folder / "cats" / f"region={region}"
    place.mkdir(parents=True, exist_ok=True)
    items = [{"id": str(i), "snippet": {"title": t}} for i, t in enumerate(titles)]
    (place / f"{region}.json").write_text(json.dumps({"items": items}, indent=2))
    return str(folder / "cats")


def rows(spark, name, columns=BUSINESS):
    return sorted(map(str, table(spark, name).select(*columns).collect()))


def videos(count, **changes):
    return [{"video_id": f"v{i}", "views": str(100 * i), "category_id": str(i)} | changes for i in range(count)]


def test_bronze_table_in_its_regions(spark, cfg, raw, databases):
    append(raw({}, {"region": "de"}, {"region": "US"}, {"video_id": "v2"}), f"{databases[0]}.raw")
    cfg = replace(cfg, bronze_table=f"{databases[0]}.raw", regions=("ca", "gb", "us", "in"))
    counts = bronze_to_silver(spark, cfg)
    assert counts["rows_read"] == 2 and counts["rows_kept"] == 2
    assert counts["null_title"] == 0 and counts["negative_views"] == 0
    assert {r.region for r in table(spark, cfg.statistics).collect()} == {"us"}


def test_without_input_nothing_is_written(spark, cfg, tmp_path):
    (tmp_path / "stats").mkdir()
    cfg = replace(cfg, csv_path=str(tmp_path / "stats"), api_path=str(tmp_path / "stats"))
    assert bronze_to_silver(spark, cfg) == {"rows_read": 0, "rows_kept": 0}
    assert not spark.catalog.tableExists(cfg.statistics)
    with pytest.raises(ValueError, match="name a"):
        bronze_to_silver(spark, replace(cfg, csv_path=None, api_path=None))


def test_append_doubles_and_merge_does_not(spark, cfg, raw):
    for mode, expected in (("append", 2), ("merge", 1)):
        run = replace(cfg, statistics_mode=mode, statistics_table=f"s_{mode}")
        for _ in range(2):
            load_statistics(from_csv(raw({})), run)
        assert table(spark, run.statistics).count() == expected
    with pytest.raises(ValueError, match="statistics_mode"):
        load_statistics(from_csv(raw({})), replace(cfg, statistics_mode="upsert"))


def test_batches_equal_one_run(spark, cfg, tmp_path):
    whole = replace(cfg, statistics_table="whole")
    path = None
    for lot, changes in enumerate([videos(4), videos(6, likes="7"), videos(2, region="ca")]):
        path = write_csv(tmp_path, changes[0].get("region", "us"), f"{lot}.csv", *changes)
        stream_statistics(spark, replace(cfg, csv_path=path), checkpoint=str(tmp_path / "progress"))
    bronze_to_silver(spark, replace(whole, csv_path=path))
    assert rows(spark, cfg.statistics) == rows(spark, whole.statistics)
    assert table(spark, cfg.statistics).count() == 8


def test_a_stream_reads_each_file_once(spark, cfg, tmp_path):
    path = write_csv(tmp_path, "us", "a.csv", *videos(3))
    cfg = replace(cfg, csv_path=path)
    progress = str(tmp_path / "progress")
    stream_statistics(spark, cfg, checkpoint=progress)
    spark.sql(f"DROP TABLE {cfg.statistics}")
    stream_statistics(spark, cfg, checkpoint=progress)
    assert not spark.catalog.tableExists(cfg.statistics)
    write_csv(tmp_path, "us", "b.csv", {"video_id": "new"})
    queries = stream_statistics(spark, cfg, checkpoint=progress, files_per_batch=1)
    assert [r.video_id for r in table(spark, cfg.statistics).collect()] == ["new"]
    assert len(queries) == 1 and queries[0].exception() is None


def test_category_stream_is_idempotent(spark, cfg, tmp_path):
    path = write_categories(tmp_path, "us", "Film", "Music")
    cfg = replace(cfg, category_path=path)
    stream_categories(spark, cfg, checkpoint=str(tmp_path / "p1"))
    columns = ["id", "`snippet.title`", "region"]
    first = rows(spark, cfg.reference, columns)
    stream_categories(spark, cfg, checkpoint=str(tmp_path / "p2"))
    assert rows(spark, cfg.reference, columns) == first and len(first) == 2
    write_categories(tmp_path, "ca", "Cinema")
    stream_categories(spark, cfg, checkpoint=str(tmp_path / "p2"))
    assert len(rows(spark, cfg.reference, columns)) == 3


def test_reference_report(spark, cfg, tmp_path):
    write_categories(tmp_path, "us", "Film")
    path = write_categories(tmp_path, "ca")
    report = reference_to_silver(spark, replace(cfg, category_path=path)).collect()
    assert {(r.region, r.status) for r in report} == {("us", "success"), ("ca", "failed")}
    assert table(spark, cfg.reference).count() == 1


@pytest.fixture
def inputs(tmp_path, cfg):
    stats = write_csv(tmp_path, "us", "a.csv", *videos(12))
    cats = write_categories(tmp_path, "us", *[f"c{i}" for i in range(10)])
    return replace(cfg, csv_path=stats, category_path=cats)


def test_whole_run(spark, inputs):
    run = run_pipeline(spark, inputs)
    assert run.quality_passed and run.checks_passed == run.checks_total == 14
    assert run.counts["rows_kept"] == 12
    assert [t.split(".")[1] for t in run.gold_tables] == [
        "trending_analytics", "channel_analytics", "category_analytics",
    ]
    names = {r.category_name for r in table(spark, inputs.gold("category_analytics")).collect()}
    assert names == {f"c{i}" for i in range(10)} | {"Unknown"}
    before = rows(spark, inputs.gold("channel_analytics"), ["*"])
    run_pipeline(spark, inputs)
    assert rows(spark, inputs.gold("channel_analytics"), ["*"]) == before


@pytest.mark.parametrize(
    "rules, as_of",
    [
        (QualityRules(min_rows=13), AS_OF),
        (QualityRules(max_views=500), AS_OF),
        (QualityRules(critical_columns={"clean_statistics": ("absent",)}), AS_OF),
    ],
)
def test_the_gate_stops_the_run(spark, inputs, rules, as_of):
    run = run_pipeline(spark, replace(inputs, rules=rules, as_of=as_of))
    assert not run.quality_passed and run.gold_tables == []
    assert not run.checks.where("not passed").isEmpty()
    assert not spark.catalog.tableExists(inputs.gold("trending_analytics"))


def test_missing_reference_table_fails_the_gate_but_not_the_summaries(spark, inputs):
    run = run_pipeline(spark, replace(inputs, category_path=None))
    assert not run.quality_passed
    assert [(r.check, r.table) for r in run.checks.where("not passed").collect()] == [
        ("read_table", "reference_data")
    ]
    silver_to_gold(spark, inputs)
    assert {r.category_name for r in table(spark, inputs.gold("category_analytics")).collect()} == {"Unknown"}


def test_summaries_of_nothing(spark, cfg, raw):
    append(from_csv(raw({})).limit(0), cfg.statistics)
    assert silver_to_gold(spark, cfg) == []


def test_summaries_can_be_appended(spark, inputs):
    bronze_to_silver(spark, inputs)
    for _ in range(2):
        silver_to_gold(spark, replace(inputs, gold_mode="append"))
    assert table(spark, inputs.gold("trending_analytics")).count() == 2


# --- landing --------------------------------------------------------------------------------

ITEMS = """{
  "items": [
    {"id": "a", "snippet": {"title": "x }\\n{ y"}, "statistics": {"viewCount": "1"}},
    {"id": "b", "unknown": [1, {"deep": true}]}
  ]
}
"""


def test_landing_and_manifest(spark, tmp_path):
    payloads = spark.createDataFrame(
        [
            (" US", "trending", ITEMS, None),
            ("us", "categories", '{"items": [{"id": "1", "snippet": {"title": "Film"}}]}', None),
            ("ca", "trending", "{}", None),
            ("gb", "trending", '{"items": [', None),
            ("gb", "categories", '{"items": []}', None),
            ("in", "trending", None, "HTTP 500"),
            ("de", "trending", "[1]", None),
            ("fr", "trending", '{"items": 5}', None),
            ("fr", "categories", "nothing", None),
        ],
        "region string, kind string, payload string, error string",
    )
    report = {
        (r.region, r.kind): (r.status, r.item_count, r.error)
        for r in land_raw(payloads, str(tmp_path), "source", AS_OF).collect()
    }
    bad = "payload is not a JSON object"
    assert report == {
        ("us", "trending"): ("success", 2, None),
        ("us", "categories"): ("success", 1, None),
        ("ca", "trending"): ("success", 0, None),
        ("gb", "trending"): ("failed", 0, bad),
        ("in", "trending"): ("failed", 0, "HTTP 500"),
        ("de", "trending"): ("failed", 0, bad),
        ("fr", "trending"): ("success", 0, None),
        ("fr", "categories"): ("failed", 0, bad),
    }
    root = tmp_path / "raw_statistics"
    landed = {
        str(p.parent.relative_to(root)): json.loads(p.read_text()) for p in root.rglob("part-*")
    }
    day = "date=2024-02-01/hour=09"
    assert set(landed) == {f"region={r}/{day}" for r in ("us", "ca", "fr")}
    us = landed[f"region=us/{day}"]
    assert us.pop("_pipeline_metadata") == {
        "ingestion_id": "20240201_093000",
        "region": "us",
        "ingestion_timestamp": "2024-02-01T09:30:00+00:00",
        "video_count": 2,
        "source": "source",
    }
    assert us == json.loads(ITEMS)
    category_files = list((tmp_path / "raw_statistics_reference_data").rglob("part-*"))
    assert len(category_files) == 1
    assert "video_count" not in json.loads(category_files[0].read_text())["_pipeline_metadata"]


def test_landed_files_are_read_back(spark, tmp_path):
    one = '{"items": [{"id": "%s", "snippet": {"title": "t"}, "statistics": {"viewCount": "5"}}]}'
    cats = '{"items": [{"id": "1", "snippet": {"title": "%s"}}]}'
    for lot, hours in (("a", 0), ("b", 3)):
        payloads = spark.createDataFrame(
            [("us", "trending", one % lot), ("us", "trending", one % (lot * 2)), ("us", "categories", cats % lot)],
            "region string, kind string, payload string",
        )
        land_raw(payloads, str(tmp_path), "source", AS_OF + timedelta(hours=hours))
    items = api_statistics(spark, f"{tmp_path}/raw_statistics", layout="lines")
    ids = [r.video_id for r in statistics_record(items, AS_OF).collect()]
    assert sorted(ids) == ["a", "aa", "b", "bb"]
    documents = category_documents(spark, f"{tmp_path}/raw_statistics_reference_data", layout="lines")
    titles = documents.select(F.explode("items.snippet.title")).collect()
    assert [r[0] for r in titles] == ["b"]
