"""The jobs: each reads a layer, composes operators, and writes the next layer."""

from tidestrata.plans.gold import silver_to_gold, summary_tables
from tidestrata.plans.landing import land_raw
from tidestrata.plans.pipeline import PipelineRun, run_pipeline
from tidestrata.plans.refresh import refresh_gold
from tidestrata.plans.silver import (
    bronze_to_silver,
    clean_statistics,
    load_categories,
    load_inputs,
    load_statistics,
    reference_to_silver,
)

__all__ = [
    "PipelineRun",
    "bronze_to_silver",
    "clean_statistics",
    "land_raw",
    "load_categories",
    "load_inputs",
    "load_statistics",
    "reference_to_silver",
    "refresh_gold",
    "run_pipeline",
    "silver_to_gold",
    "summary_tables",
]
