"""Layered analytics over video-trend statistics, written as plain Spark jobs.

Raw files -> cleaned statistics and category names -> quality gate -> summary tables.
Operators are lazy ``DataFrame -> DataFrame`` functions; only the jobs in ``plans`` and
``streaming``, the sinks, and the few steps whose docstring says so start Spark actions.
"""

from tidestrata.config import PipelineConfig, QualityRules

__all__ = ["PipelineConfig", "QualityRules"]
