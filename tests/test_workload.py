"""Each query against its SQL on the smallest tables."""

import pytest

import __spark_entry__
from tidestrata.__main__ import configuration
from workload.compare import TESTDATA, differences
from workload.oracles import ORACLES
from workload.queries import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_on_both_engines(spark, name):
    assert differences(spark, name, f"{TESTDATA}/sf0.001") is None


def test_entry_file(spark):
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    frame = __spark_entry__.entry(spark)
    assert frame.columns[:2] == ["region", "trending_date_parsed"] and not frame.isEmpty()


def test_command_line():
    job, cfg = configuration(
        ["run", "--csv-path", "/raw", "--regions", "us,de", "--min-rows", "3", "--gold-database", "g"]
    )
    assert (job, cfg.csv_path, cfg.regions, cfg.rules.min_rows) == ("run", "/raw", ("us", "de"), 3)
    assert cfg.gold("t") == "g.t" and cfg.statistics == "silver.clean_statistics"
    assert configuration(["check"])[1].regions == ("ca", "gb", "us", "in")
    assert configuration(["check", "--regions", "all"])[1].regions is None
    job, cfg = configuration(
        ["land", "--payload-table", "raw.p", "--landing-path", "/raw", "--checked-tables", "a,b",
         "--statistics-partitions", "region", "--category-schema", "id STRING"]
    )
    assert (job, cfg.payload_table, cfg.landing_path) == ("land", "raw.p", "/raw")
    assert cfg.checked_tables == ("a", "b") and cfg.statistics_partitions == ("region",)
    assert cfg.category_schema.names == ["id"]
