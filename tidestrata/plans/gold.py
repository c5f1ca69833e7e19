"""Cleaned statistics into the three summary tables."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from tidestrata.config import PipelineConfig
from tidestrata.operators.categories import category_lookup
from tidestrata.operators.summaries import (
    aggregated,
    category_trends,
    channel_performance,
    daily_trends,
)
from tidestrata.sinks import append, publish
from tidestrata.sources import has_rows, optional_table, table

log = logging.getLogger(__name__)


def summary_tables(
    facts: DataFrame, reference: DataFrame | None, cfg: PipelineConfig
) -> dict[str, DataFrame]:
    """The summary tables by name.

    Each reads the facts on its own with just its columns. Keeping the facts cached for all
    three would hold every column of the largest table for the sake of a dozen narrow ones.
    """
    lookup = category_lookup(reference)
    if lookup is None:
        log.warning("no category names; every category is Unknown")
    tables = {
        "trending_analytics": daily_trends(facts),
        "channel_analytics": channel_performance(facts, lookup),
        "category_analytics": category_trends(facts, lookup),
    }
    return {name: aggregated(frame, cfg.as_of) for name, frame in tables.items()}


def silver_to_gold(spark: SparkSession, cfg: PipelineConfig) -> list[str]:
    """Build and write the summary tables; gives their names, none without statistics.

    They are published together: a run that dies before its end leaves all three as they were.
    """
    facts = table(spark, cfg.statistics)
    if not has_rows(facts):
        log.warning("no statistics in %s", cfg.statistics)
        return []
    tables = summary_tables(facts, optional_table(spark, cfg.reference), cfg)
    named = {cfg.gold(name): frame for name, frame in tables.items()}
    if cfg.gold_mode == "append":
        for name, frame in named.items():
            append(frame, name, ["region"])
    else:
        publish(named, cfg.gold_database)
    return list(named)
