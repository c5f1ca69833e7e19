from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF
from tidestrata.operators.conform import from_csv
from tidestrata.plans import clean_statistics
from tidestrata.sinks import append, merge, merge_latest, overwrite_partitions
from tidestrata.sources import optional_table, table
from tidestrata.workspace import shared_folder

BY_DAY = ("region", "trending_date_parsed")


def frame(spark, *rows, schema="v long, region string"):
    return spark.createDataFrame(list(rows), schema)


def content(spark, name):
    return sorted(map(tuple, table(spark, name).collect()), key=str)


@pytest.fixture
def name(databases):
    return f"{databases[0]}.t"


def test_append_creates_then_adds(spark, name):
    append(frame(spark, (1, "a"), (2, "b")), name)
    append(frame(spark, (1, "a")), name)
    assert content(spark, name) == [(1, "a"), (1, "a"), (2, "b")]


def test_append_goes_by_name(spark, name):
    append(frame(spark, (1, "a")), name)
    append(frame(spark, ("b", 2), schema="region string, v long"), name)
    assert content(spark, name) == [(1, "a"), (2, "b")]


def test_overwrite_replaces_only_its_partitions(spark, name):
    overwrite_partitions(frame(spark, (1, "a"), (2, "b"), (3, None)), name)
    for _ in range(2):
        overwrite_partitions(frame(spark, (9, "a"), (8, "c")), name)
        assert content(spark, name) == [(2, "b"), (3, None), (8, "c"), (9, "a")]


def test_overwrite_spares_partitions_of_a_table_made_elsewhere(spark, name):
    frame(spark, (1, "a"), (2, "b")).write.partitionBy("region").format("parquet").saveAsTable(name)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"
    overwrite_partitions(frame(spark, (9, "a")), name)
    assert content(spark, name) == [(2, "b"), (9, "a")]


def test_new_and_missing_columns(spark, name):
    overwrite_partitions(frame(spark, (1, "a"), (2, "b")), name)
    wide = frame(spark, (3, "x", "a"), schema="v long, `snippet.new` string, region string")
    overwrite_partitions(wide, name)
    assert content(spark, name) == [(2, None, "b"), (3, "x", "a")]
    append(frame(spark, (4, "c")), name)
    assert content(spark, name) == [(2, None, "b"), (3, "x", "a"), (4, None, "c")]


def test_optional_table(spark, name):
    assert optional_table(spark, name) is None
    append(frame(spark, (1, "a")), name)
    assert optional_table(spark, name).count() == 1


def test_a_large_region_is_written_by_several_tasks(spark, name, tmp_path):
    """Skewed output is split by size, so one region is not one task's work."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        noise = F.sha2(F.col("id").cast("string"), 256).alias("noise")
        append(spark.range(40_000).repartition(8).select(noise, F.lit("big").alias("region")), name)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "silver").rglob("region=big/*.parquet"))) > 3


# --- merging --------------------------------------------------------------------------------


def cleaned(raw, *changes, hours=0):
    moment = AS_OF + timedelta(hours=hours)
    return clean_statistics(from_csv(raw(*changes)), "job", moment)


def likes(spark, name):
    rows = table(spark, name).select("video_id", "region", "trending_date_parsed", "likes").collect()
    return {(r[0], r[1], str(r[2])): r[3] for r in rows}, len(rows)


@pytest.mark.parametrize("partition_by", [BY_DAY, ("region",)])
def test_merge(spark, raw, name, partition_by):
    old = [{"likes": "1"}, {"video_id": "v2", "likes": "2"}, {"trending_date": "junk", "likes": "3"},
           {"region": "ca", "likes": "4"}, {"trending_date": "17.15.11", "likes": "5"}]
    merge_latest(cleaned(raw, *old), name, partition_by)
    new = [{"likes": "10"}, {"video_id": "v3", "likes": "30"}, {"trending_date": "junk", "likes": "0"}]
    for _ in range(2):
        merge_latest(cleaned(raw, *new, hours=6), name, partition_by)
        assert likes(spark, name) == (
            {
                ("v1", "us", "2017-11-14"): 10,
                ("v2", "us", "2017-11-14"): 2,
                ("v3", "us", "2017-11-14"): 30,
                ("v1", "us", "None"): 0,
                ("v1", "ca", "2017-11-14"): 4,
                ("v1", "us", "2017-11-15"): 5,
            },
            6,
        )


def test_a_merge_reads_a_range_of_partitions(spark, raw, name, capfd):
    days = [{"trending_date": f"17.{d}.11"} for d in (13, 14, 15, 16)] + [{"trending_date": "junk"}]
    merge_latest(cleaned(raw, *days), name, BY_DAY)
    touched = cleaned(raw, days[1], days[3], days[4]).select(*BY_DAY).distinct()
    found = merge.only_partitions(table(spark, name), touched, BY_DAY)
    assert sorted(str(r.trending_date_parsed) for r in found.collect()) == ["2017-11-14", "2017-11-16", "None"]
    found.explain()
    filters = next(x for x in capfd.readouterr().out.split("PartitionFilters: ")[1:]).split("]")[0]
    assert "2017-11-14" in filters and "2017-11-16" in filters and "us" in filters
    assert merge.only_partitions(table(spark, name), touched.limit(0), BY_DAY).count() == 0


def test_staged_rows_are_removed(spark, raw, name):
    staged = Path(shared_folder(spark).removeprefix("file:")) / "merge" / name.replace(".", "/")
    for hours in (0, 6):
        merge_latest(cleaned(raw, {}, hours=hours), name, BY_DAY)
    assert staged.is_dir() and list(staged.iterdir()) == []


def test_an_older_run_does_not_win(spark, raw, name):
    merge_latest(cleaned(raw, {"likes": "1"}, hours=6), name, BY_DAY)
    merge_latest(cleaned(raw, {"likes": "9"}), name, BY_DAY)
    assert list(likes(spark, name)[0].values()) == [1]


def test_a_merge_leaves_other_partitions_files_alone(spark, raw, name, tmp_path):
    days = [{"trending_date": f"17.{d}.11"} for d in (14, 15, 16)]
    merge_latest(cleaned(raw, *days), name, BY_DAY)
    before = set((tmp_path / "silver").rglob("*.parquet"))
    merge_latest(cleaned(raw, days[1], hours=6), name, BY_DAY)
    after = set((tmp_path / "silver").rglob("*.parquet"))
    assert len(before & after) == 2 and len(after) == 3


def test_partitions_outside_the_key_are_refused(spark, raw, name):
    with pytest.raises(ValueError, match="part of the key"):
        merge_latest(cleaned(raw, {}), name, ("channel_title",))
