"""The whole run: clean both inputs, check them, and summarise only if the checks pass."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidestrata.config import PipelineConfig
from tidestrata.operators.quality import check_tables, verdict
from tidestrata.plans.gold import silver_to_gold
from tidestrata.plans.silver import bronze_to_silver, reference_to_silver

log = logging.getLogger(__name__)


@dataclass
class PipelineRun:
    """What a run did. ``checks`` is the table of check results."""

    quality_passed: bool
    checks_passed: int
    checks_total: int
    checks: DataFrame
    counts: dict[str, int] = field(default_factory=dict)
    category_report: DataFrame | None = None
    gold_tables: list[str] = field(default_factory=list)


def checked(spark: SparkSession, cfg: PipelineConfig) -> PipelineRun:
    """The gate alone, over the cleaned tables: both, or those that ``cfg.checked_tables`` names."""
    names = cfg.checked_tables or (cfg.statistics_table, cfg.reference_table)
    tables = {name: f"{cfg.silver_database}.{name}" for name in names}
    checks = check_tables(spark, tables, cfg.rules, cfg.as_of)
    row = verdict(checks).drop("details").first()
    return PipelineRun(row["quality_passed"], row["checks_passed"], row["checks_total"], checks)


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> PipelineRun:
    """Run all layers. A failed check stops the run before any summary table is touched."""
    counts = bronze_to_silver(spark, cfg)
    report = reference_to_silver(spark, cfg) if cfg.category_path else None
    run = checked(spark, cfg)
    run.counts, run.category_report = counts, report
    if run.quality_passed:
        run.gold_tables = silver_to_gold(spark, cfg)
    else:
        log.error("%s of %s checks passed; summaries left alone", run.checks_passed, run.checks_total)
    return run
