"""Files at other depths and of other spellings, and files that no reader takes."""

import gzip

from dataclasses import replace

import pytest
from pyspark.errors import StreamingQueryException

from tidestrata.plans import bronze_to_silver, reference_to_silver
from tidestrata.sources import api_statistics, category_documents, csv_input, csv_statistics, table
from tidestrata.sources import statistics as statistics_source
from tidestrata.streaming import stream_categories, stream_statistics


def test_every_depth_and_spelling_is_read(spark, tmp_path):
    deep = tmp_path / "region=us" / "date=2024-01-01"
    deep.mkdir(parents=True)
    (tmp_path / "region=us" / "a.Csv").write_text("video_id\nv1\n")
    (deep / "b.csv").write_text("video_id\nv2\n")
    with gzip.open(deep / "c.CSV.gz", "wt") as file:
        file.write("video_id\nv3\n")
    (deep / "d.Json").write_text('{"items":[{"id":"v4"}]}')
    assert {(r.video_id, r.region) for r in csv_statistics(spark, str(tmp_path)).collect()} == {
        ("v1", "us"), ("v2", "us"), ("v3", "us")
    }
    assert [(r.id, r.region) for r in api_statistics(spark, str(tmp_path)).collect()] == [("v4", "us")]


@pytest.mark.parametrize("name", ["region=us/noext", "region=us/x.csv.zst", "region=us/x.json.lz4", "region=us/x.csv.GZ"])
def test_files_that_no_reader_takes_are_named(spark, tmp_path, name):
    (tmp_path / "region=us").mkdir()
    (tmp_path / "region=us" / "a.csv").write_text("video_id\nv1\n")
    (tmp_path / name).write_bytes(b"x")
    for read in (csv_statistics, api_statistics, category_documents):
        with pytest.raises(ValueError, match=name.rpartition("/")[2]):
            read(spark, str(tmp_path))


HEADER = "video_id,title,channel_title,views,trending_date\n"
GOOD = "v%d,t,c,5,17.14.11\n"
ITEMS = '{"items":[{"id":"%s","snippet":{"title":"t","channelTitle":"c"},"statistics":{"viewCount":"1"}}]}'


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def refused_rows(spark, cfg):
    rows = table(spark, cfg.rejected).select("load", "source", "region", "reason", "record", "file").collect()
    return sorted((r.source, r.region, r.reason, r.record, r.file.rpartition("/")[2], r.load) for r in rows)


def test_ragged_rows_and_cut_documents_are_set_aside(spark, cfg, tmp_path):
    """Rows in are rows kept and rows set aside, in a batch run and again in the same one."""
    put(tmp_path / "raw" / "region=us" / "a.csv", HEADER + GOOD % 1 + "v2,only three,c\n" + GOOD % 3 + "v4,one,too,many,5,x\n")
    put(tmp_path / "raw" / "region=us" / "date=d" / "hour=h" / "good.json", ITEMS % "w1")
    put(tmp_path / "raw" / "region=us" / "date=d" / "hour=h" / "cut.json", (ITEMS % "w2")[:30])
    put(tmp_path / "raw" / "region=us" / "date=d" / "hour=h" / "list.json", '{"kind": "videos"}')
    cfg = replace(cfg, csv_path=f"{tmp_path}/raw", api_path=f"{tmp_path}/raw")
    for _ in range(2):
        counts = bronze_to_silver(spark, cfg)
        assert (counts["rows_read"], counts["rows_kept"], counts["rows_rejected"]) == (3, 3, 4)
        found = refused_rows(spark, cfg)
        assert [row[:-1] for row in found] == [
            ("api", "us", "no list of items", None, "list.json"),
            ("api", "us", "not readable as JSON", (ITEMS % "w2")[:30], "cut.json"),
            ("csv", "us", "fields do not match the header", "v2,only three,c", "a.csv"),
            ("csv", "us", "fields do not match the header", "v4,one,too,many,5,x", "a.csv"),
        ]
        assert len({row[-1] for row in found}) == 1


def test_input_without_a_good_row_is_set_aside(spark, cfg, tmp_path):
    put(tmp_path / "raw" / "region=us" / "a.csv", HEADER + "v1\n")
    cfg = replace(cfg, csv_path=f"{tmp_path}/raw")
    assert bronze_to_silver(spark, cfg) == {"rows_read": 0, "rows_kept": 0, "rows_rejected": 1}
    assert not spark.catalog.tableExists(cfg.statistics)
    assert [row[3] for row in refused_rows(spark, cfg)] == ["v1"]


def test_streams_read_any_file_and_set_bad_ones_aside(spark, cfg, tmp_path):
    """Three depths, two header orders, an upper-case ending, and a bad file in each of two batches."""
    raw, progress = tmp_path / "raw", str(tmp_path / "progress")
    cfg = replace(cfg, csv_path=str(raw), api_path=str(raw))
    put(raw / "region=us" / "a.csv", HEADER + GOOD % 1)
    put(raw / "region=us" / "date=d" / "bad.json", "{")
    stream_statistics(spark, cfg, checkpoint=progress)
    put(raw / "region=us" / "b.Csv", "views,video_id,trending_date\n7,v2,17.14.11\n")
    put(raw / "region=us" / "date=2024-01-01" / "c.CSV", HEADER + GOOD % 3 + "ragged\n")
    put(raw / "region=us" / "date=d" / "hour=h" / "d.JSON", ITEMS % "v4")
    stream_statistics(spark, cfg, checkpoint=progress)
    kept = {r.video_id: r.views for r in table(spark, cfg.statistics).collect()}
    assert kept == {"v1": 5, "v2": 7, "v3": 5, "v4": 1}
    found = refused_rows(spark, cfg)
    assert [row[:4] for row in found] == [
        ("api", "us", "not readable as JSON", "{"), ("csv", "us", "fields do not match the header", "ragged")
    ]
    assert found[0][-1].startswith("api-") and found[0][-1].endswith("-0") and found[1][-1].endswith("-1")


def test_a_stream_fails_by_the_name_of_an_unknown_file(spark, cfg, tmp_path):
    put(tmp_path / "raw" / "region=us" / "a.csv", HEADER + GOOD % 1)
    put(tmp_path / "raw" / "region=us" / "b.csv.zst", "x")
    with pytest.raises(StreamingQueryException, match="b.csv.zst"):
        stream_statistics(spark, replace(cfg, csv_path=str(tmp_path / "raw")), checkpoint=f"{tmp_path}/progress")


def test_category_streams_name_unreadable_files(spark, cfg, tmp_path):
    raw = tmp_path / "raw"
    put(raw / "region=us" / "a.json", '{"items":[{"id":"1","snippet":{"title":"Film"}}]}')
    put(raw / "region=ca" / "b.json", '{"items":[{"id"')
    put(raw / "region=gb" / "c.json", '{"items":[]}')
    cfg = replace(cfg, category_path=str(raw))
    stream_categories(spark, cfg, checkpoint=str(tmp_path / "progress"))
    expected = [
        ("categories", "ca", "not readable as JSON", '{"items":[{"id"', "b.json"),
        ("categories", "gb", "no category items found", None, "c.json"),
    ]
    assert [row[:-1] for row in refused_rows(spark, cfg)] == expected
    reference_to_silver(spark, cfg)
    assert len(refused_rows(spark, cfg)) == 4 and table(spark, cfg.reference).count() == 1


def test_files_of_other_regions_are_not_opened(spark, cfg, tmp_path, monkeypatch):
    """A file that is no text at all does no harm where its region is not asked for."""
    put(tmp_path / "raw" / "region=us" / "a.csv", HEADER + GOOD % 1)
    (tmp_path / "raw" / "region=ca").mkdir()
    (tmp_path / "raw" / "region=ca" / "b.csv.gz").write_bytes(b"no gzip")
    opened = []
    first_lines = statistics_source.first_lines
    monkeypatch.setattr(
        statistics_source, "first_lines", lambda s, files: opened.extend(files) or first_lines(s, files)
    )
    assert csv_input(spark, str(tmp_path / "raw"), regions=("us",)).count() == 1
    assert [file.rpartition("/")[2] for file in opened] == ["a.csv"]
    assert bronze_to_silver(spark, replace(cfg, csv_path=str(tmp_path / "raw"), regions=("us",)))["rows_kept"] == 1


def test_headers_take_no_pass_over_files(spark, tmp_path):
    """A plan over files with one header has one scan, which is of CSV."""
    for region in ("us", "ca"):
        put(tmp_path / f"region={region}" / "a.csv", HEADER + GOOD % 1)
    plan = csv_statistics(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "FileScan text" not in plan
