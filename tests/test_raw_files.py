"""Files and payloads as they come: headers, missing roots, numbers, and what counts as an object."""

import gzip
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from tidestrata.functions import instant_value, iso_text, whole_number
from tidestrata.operators.landing import is_object
from tidestrata.plans import land_raw
from tidestrata.sources import csv_statistics
from tidestrata.workspace import shared_folder


@pytest.mark.parametrize(
    "value, kind, expected",
    [
        (1.5e7, DoubleType(), 15_000_000),
        (12.7, DoubleType(), 12),
        (float("nan"), DoubleType(), None),
        (1e30, DoubleType(), None),
        (123456792.0, FloatType(), 123456792),
        (Decimal("20000000.99"), DecimalType(20, 2), 20_000_000),
        (None, DoubleType(), None),
    ],
)
def test_numbers_stay_numbers(spark, value, kind, expected):
    frame = spark.range(1).select(whole_number(F.lit(value).cast(kind), kind).alias("n"))
    assert frame.first().n == expected


def test_columns_go_by_header(spark, tmp_path):
    (tmp_path / "region=us").mkdir()
    (tmp_path / "region=a{b}c d").mkdir()
    (tmp_path / "region=us" / "a.csv").write_text('title,video_id,views\n"x\ny",v1,5\n')
    (tmp_path / "region=us" / "b.csv").write_text("\ufeffvideo_id,other,title\nv2,o,t\n")
    with gzip.open(tmp_path / "region=a{b}c d" / "c.csv.gz", "wt") as file:
        file.write("views,video_id\n7,v3\n")
    rows = {r.video_id: r for r in csv_statistics(spark, str(tmp_path)).collect()}
    assert (rows["v1"].title, rows["v1"].views, rows["v1"].region) == ("x\ny", "5", "us")
    assert (rows["v2"].title, rows["v2"].views) == ("t", None)
    assert (rows["v3"].views, rows["v3"].region, rows["v3"].title) == ("7", "a{b}c d", None)


def test_a_missing_root_is_an_error_and_an_empty_one_is_not(spark, tmp_path):
    assert csv_statistics(spark, str(tmp_path)).count() == 0
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        csv_statistics(spark, f"{tmp_path}/none")


@pytest.mark.parametrize(
    "payload, good",
    [
        ('{"items":[]}', True),
        ('{"a":1,"a":2,"items":[]}', True),
        ('{\n  "a": [\n1]\n}\n', True),
        ("{}", True),
        ('{"items":[]} trailing', False),
        ('{"a":"one\ntwo"}', False),
        ('{"items":[', False),
        ("{},{}", False),
        ("[{}]", False),
        ("null", False),
        ("5", False),
        ("", False),
        (None, False),
        ('{"a":"' + "x" * 3_000_000 + '"}', True),
    ],
)
def test_one_object(spark, payload, good):
    frame = spark.createDataFrame([(payload,)], "p string")
    assert frame.select(is_object(F.col("p")).alias("x")).first().x is good


def test_one_instant_for_a_run(spark, tmp_path):
    rows = [("US", "trending", '{"items":[1]}'), ("US", "categories", '{"items":[]}')]
    manifest = land_raw(spark.createDataFrame(rows, "region string, kind string, payload string"), str(tmp_path), "s")
    landed = spark.read.option("recursiveFileLookup", True).text(str(tmp_path))
    ids = {r[0] for r in landed.select(F.get_json_object("value", "$._pipeline_metadata.ingestion_id")).collect()}
    assert ids == {r.ingestion_id for r in manifest.collect()} and len(ids) == 1


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="all executors share"):
        shared_folder(Session())


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-02-01 09:30:00", "2024-02-01T09:30:00+00:00"),
        ("2024-02-01T09:30:00Z", "2024-02-01T09:30:00+00:00"),
        ("2024-02-01T09:30:00+02:00", "2024-02-01T07:30:00+00:00"),
        ("2024-02-01", "2024-02-01T00:00:00+00:00"),
        ("soon", None),
        (None, None),
    ],
)
def test_times_without_a_zone_are_utc(spark, zone, text, expected):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame([(text,)], "t string")
        assert frame.select(iso_text(instant_value(F.col("t"))).alias("x")).first().x == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_csv_lines_are_split(spark, tmp_path):
    (tmp_path / "region=us").mkdir()
    lines = ["video_id,title", *(f'v{i},"a ""t"", {i}"' for i in range(2000))]
    (tmp_path / "region=us" / "a.csv").write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        frame = csv_statistics(spark, str(tmp_path), layout="lines")
        assert frame.rdd.getNumPartitions() > 1
        assert {(r.video_id, r.title) for r in frame.collect()} == {(f"v{i}", f'a "t", {i}') for i in range(2000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
