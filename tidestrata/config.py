"""Settings of the jobs. Every value has the default a plain run needs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql.types import StructType

# The region partitions a statistics run reads unless told otherwise.
DEFAULT_REGIONS = ("ca", "gb", "us", "in")

# The columns that have to exist and be filled, per cleaned table.
CRITICAL_COLUMNS = {
    "clean_statistics": ("video_id", "title", "channel_title", "views", "region"),
    "reference_data": ("id", "region"),
}

# Fixed value: the table whose view counts are range checked.
RANGE_CHECKED_TABLE = "clean_statistics"


@dataclass(frozen=True)
class QualityRules:
    """Thresholds of the quality gate; ``sample_rows`` limits the rows looked at.

    With ``sample_key`` the sample is the same in every run (``sources.tables.bounded_sample``).
    """

    # The gate's default limits.
    min_rows: int = 10
    max_null_pct: float = 5.0
    freshness_hours: int = 48
    max_views: int = 50_000_000_000
    critical_columns: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: dict(CRITICAL_COLUMNS)
    )
    sample_rows: int | None = None
    sample_key: tuple[str, ...] = ()


@dataclass(frozen=True)
class PipelineConfig:
    """Where each layer lives and how a run behaves.

    Raw statistics come from any mix of a catalogue table, CSV files and API documents.
    ``api_layout`` is ``"documents"`` for one pretty-printed document per file, or ``"lines"``
    for one document per line, which is what :func:`tidestrata.plans.landing.land_raw` writes
    and what Spark can split. ``csv_layout="lines"`` says that no CSV field holds a line break, so
    that these files can be split as well.

    ``category_schema`` fixes the fields of category items; without it they are found in the files.
    Input that cannot be read is set aside in ``rejected_table``, beside the cleaned tables.

    ``checked_tables`` are the cleaned tables that the gate looks at; None means both.

    Cleaned statistics are partitioned by region and, below it, by day: a merge rewrites whole
    partitions, and a new day's files should not rewrite a region's history. ``("region",)`` keeps
    region alone.
    """

    bronze_table: str | None = None
    csv_path: str | None = None
    api_path: str | None = None
    category_path: str | None = None
    csv_layout: str = "documents"
    api_layout: str = "documents"
    category_layout: str = "documents"
    category_schema: StructType | None = None
    payload_table: str | None = None
    landing_path: str | None = None
    landing_source: str = "api"

    silver_database: str = "silver"
    gold_database: str = "gold"
    statistics_table: str = "clean_statistics"
    reference_table: str = "reference_data"
    rejected_table: str = "rejected_input"

    regions: tuple[str, ...] | None = DEFAULT_REGIONS
    statistics_mode: str = "merge"
    statistics_partitions: tuple[str, ...] = ("region", "trending_date_parsed")
    gold_mode: str = "overwrite"
    job_name: str = "bronze_to_silver"
    as_of: datetime | None = None
    rules: QualityRules = field(default_factory=QualityRules)
    checked_tables: tuple[str, ...] | None = None

    @property
    def statistics(self) -> str:
        return f"{self.silver_database}.{self.statistics_table}"

    @property
    def reference(self) -> str:
        return f"{self.silver_database}.{self.reference_table}"

    @property
    def rejected(self) -> str:
        return f"{self.silver_database}.{self.rejected_table}"

    @property
    def changes(self) -> str:
        """The log of region days that loads have touched."""
        return f"{self.silver_database}.changed_days"

    @property
    def loads(self) -> str:
        """The ledger of stream batches that have been appended."""
        return f"{self.silver_database}.appended_loads"

    def gold(self, table: str) -> str:
        return f"{self.gold_database}.{table}"
