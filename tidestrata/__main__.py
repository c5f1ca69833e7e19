"""Command line of the jobs, for spark-submit or ``python -m tidestrata``.

    python -m tidestrata run --csv-path /raw/statistics --category-path /raw/categories
    python -m tidestrata bronze-to-silver --bronze-table bronze.raw_statistics
    python -m tidestrata silver-to-gold --silver-database silver --gold-database gold
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from tidestrata.config import DEFAULT_REGIONS, PipelineConfig, QualityRules
from tidestrata.plans import (
    bronze_to_silver,
    reference_to_silver,
    refresh_gold,
    run_pipeline,
    silver_to_gold,
)
from tidestrata.plans.landing import land
from tidestrata.plans.pipeline import checked
from tidestrata.streaming import stream_categories, stream_statistics

TEXT_OPTIONS = (
    "bronze_table", "csv_path", "api_path", "category_path", "csv_layout", "api_layout",
    "category_layout", "payload_table", "landing_path", "landing_source",
    "silver_database", "gold_database", "statistics_table", "reference_table", "rejected_table",
    "statistics_mode", "gold_mode", "job_name",
)
RULE_OPTIONS = {
    "min_rows": int, "max_null_pct": float, "freshness_hours": int, "max_views": int,
    "sample_rows": int,
}


def gate(spark: SparkSession, cfg: PipelineConfig) -> bool:
    run = checked(spark, cfg)
    run.checks.select("table", "check", "column", "passed", "message").show(100, truncate=False)
    return run.quality_passed


def whole_run(spark: SparkSession, cfg: PipelineConfig) -> bool:
    run = run_pipeline(spark, cfg)
    run.checks.where("NOT passed").select("table", "check", "message").show(100, truncate=False)
    return run.quality_passed


def reference(spark: SparkSession, cfg: PipelineConfig) -> None:
    reference_to_silver(spark, cfg).show(100, truncate=False)


def landing(spark: SparkSession, cfg: PipelineConfig) -> bool:
    manifest = land(spark, cfg)
    manifest.show(1000, truncate=False)
    return manifest.where("status <> 'success'").isEmpty()


JOBS = {
    "land": landing,
    "bronze-to-silver": bronze_to_silver,
    "reference-to-silver": reference,
    "check": gate,
    "silver-to-gold": silver_to_gold,
    "refresh-gold": refresh_gold,
    "run": whole_run,
    "load-new-statistics": stream_statistics,
    "load-new-categories": stream_categories,
}


def names(given: str) -> tuple[str, ...]:
    return tuple(given.split(","))


def parser() -> argparse.ArgumentParser:
    made = argparse.ArgumentParser(prog="tidestrata", description=__doc__.splitlines()[0])
    made.add_argument("job", choices=JOBS)
    for name in TEXT_OPTIONS:
        made.add_argument(f"--{name.replace('_', '-')}")
    for name, kind in RULE_OPTIONS.items():
        made.add_argument(f"--{name.replace('_', '-')}", type=kind)
    made.add_argument(
        "--regions",
        default=",".join(DEFAULT_REGIONS),
        help="region partitions to read, comma separated, or 'all'",
    )
    made.add_argument("--checked-tables", type=names, help="tables of the gate, comma separated")
    made.add_argument("--statistics-partitions", type=names, help="comma separated")
    made.add_argument(
        "--category-schema", type=StructType.fromDDL, help="fields of category items, as DDL"
    )
    return made


def configuration(arguments: list[str]) -> tuple[str, PipelineConfig]:
    given = {k: v for k, v in vars(parser().parse_args(arguments)).items() if v is not None}
    regions = None if given["regions"] == "all" else tuple(given["regions"].split(","))
    rules = QualityRules(**{k: given[k] for k in RULE_OPTIONS if k in given})
    others = ("checked_tables", "statistics_partitions", "category_schema")
    texts = {k: given[k] for k in (*TEXT_OPTIONS, *others) if k in given}
    return given["job"], PipelineConfig(**texts, regions=regions, rules=rules)


def main(arguments: list[str]) -> int:
    job, cfg = configuration(arguments)
    spark = (
        SparkSession.builder.appName(f"tidestrata {job}")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    return 1 if JOBS[job](spark, cfg) is False else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
