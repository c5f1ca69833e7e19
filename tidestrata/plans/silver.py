"""Raw statistics and category documents into the cleaned layer."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestrata.config import PipelineConfig
from tidestrata.functions import instant
from tidestrata.operators.categories import document_report, reference_records
from tidestrata.operators.cleanse import RATES, cleansed, keyed, stamped, with_rates
from tidestrata.operators.columns import quoted
from tidestrata.operators.conform import statistics_record
from tidestrata.operators.counts import clean_measures, observed, raw_measures
from tidestrata.operators.latest import latest_records
from tidestrata.sinks import append, append_once, log_changes, log_names, merge_latest, overwrite_partitions
from tidestrata.sinks.merge import discard, stored
from tidestrata.sources import (
    accepted,
    api_input,
    category_documents,
    csv_input,
    has_rows,
    keep_regions,
    refused,
    refused_documents,
    table,
)
from tidestrata.sources.rejected import REASON
from tidestrata.workspace import scratch_folder

log = logging.getLogger(__name__)


def clean_statistics(
    records: DataFrame, job_name: str, as_of: datetime | None = None
) -> DataFrame:
    """Statistics records cleansed, stamped, and one per video, region and day.

    Rates follow from a record's own counts, so they are derived after the shuffle that picks the newest.
    """
    kept = latest_records(stamped(keyed(records.drop(*RATES)), job_name, as_of))
    order = stamped(cleansed(records), job_name, as_of).columns
    return with_rates(kept).select(*[quoted(c) for c in order])


def raw_inputs(spark: SparkSession, cfg: PipelineConfig) -> dict[str, DataFrame]:
    """The configured raw sources by kind, with marks on what cannot be read."""
    inputs = {}
    if cfg.bronze_table:
        inputs["table"] = table(spark, cfg.bronze_table)
    if cfg.csv_path:
        inputs["csv"] = csv_input(spark, cfg.csv_path, layout=cfg.csv_layout, regions=cfg.regions)
    if cfg.api_path:
        inputs["api"] = api_input(spark, cfg.api_path, layout=cfg.api_layout, regions=cfg.regions)
    if not inputs:
        raise ValueError("name a bronze_table, csv_path or api_path to read")
    return inputs


def raw_records(inputs: Mapping[str, DataFrame], cfg: PipelineConfig) -> DataFrame:
    """The good rows of all sources as statistics records, chosen regions only."""
    kept = [keep_regions(accepted(frame), cfg.regions) for frame in inputs.values()]
    return reduce(DataFrame.unionByName, [statistics_record(frame, cfg.as_of) for frame in kept])


def run_name(cfg: PipelineConfig) -> str:
    """What a batch run's rejected input is filed under: its instant."""
    return (cfg.as_of or datetime.now(timezone.utc)).strftime("run-%Y%m%dT%H%M%S%f")


def set_aside(rejected: DataFrame, cfg: PipelineConfig, load: str) -> None:
    """Write rejected input under the name of its load; a load that comes again replaces its rows."""
    stamped = rejected.withColumns({"_rejected_at": instant(cfg.as_of), "load": F.lit(load)})
    overwrite_partitions(stamped, cfg.rejected, ["load"])


def load_inputs(
    inputs: Mapping[str, DataFrame], cfg: PipelineConfig, load: str | None = None
) -> dict[str, int]:
    """Clean and write the good rows of marked frames, and set the others aside; gives the run's counts.

    ``load`` names a batch of a stream, which may come again; a run of its own has none.

    Marked rows are counted on the side by the pass that writes the good ones. Only where there are any
    is the input read once more, to write them to the table of rejected input.
    """
    stream_load, load = load, load or run_name(cfg)
    kept = {name: keep_regions(frame, cfg.regions) for name, frame in inputs.items()}
    marked = [name for name, frame in kept.items() if REASON in frame.columns]
    if has_rows(raw_records(kept, cfg)):
        bad = F.count_if(F.col(REASON).isNotNull()).alias("bad")
        watched = {name: observed(kept[name], [bad]) for name in marked}
        counted = kept | {name: frame for name, (frame, _) in watched.items()}
        counts = write_statistics(raw_records(counted, cfg), cfg, stream_load)
        marked = [name for name, (_, watch) in watched.items() if watch.get["bad"]]
        counts["rows_rejected"] = sum(watch.get["bad"] for _, watch in watched.values())
    else:
        log.info("no new statistics")
        counts = {"rows_read": 0, "rows_kept": 0}
    rejected = [refused(kept[name], name) for name in marked]
    if rejected and has_rows(every := reduce(DataFrame.unionByName, rejected)):
        every, watch = observed(every, [F.count(F.lit(1)).alias("bad")])
        set_aside(every, cfg, load)
        counts["rows_rejected"] = watch.get["bad"]
        log.warning("%s rows or documents are unreadable; see %s", watch.get["bad"], cfg.rejected)
    return counts


def load_statistics(records: DataFrame, cfg: PipelineConfig) -> dict[str, int]:
    """Clean ``records`` and write them; gives the run's counts."""
    if not has_rows(records):
        log.info("no new statistics")
        return {"rows_read": 0, "rows_kept": 0}
    return write_statistics(records, cfg)


def write_statistics(
    records: DataFrame, cfg: PipelineConfig, load: str | None = None
) -> dict[str, int]:
    """Clean ``records``, of which there are some, and write them.

    The clean rows are computed once, into the shared folder, and their counts observed on the side; rates
    are derived as the rows are written, so they take no room there nor in shuffles. The
    region days they touch are logged around the write, for ``refresh_gold``. In append mode a ``load``
    that is named is appended once however often it comes.
    """
    if cfg.statistics_mode not in ("merge", "append"):
        raise ValueError(f"statistics_mode is merge or append, not {cfg.statistics_mode!r}")
    spark = records.sparkSession
    records, read = observed(records, raw_measures())
    clean = clean_statistics(records, cfg.job_name, cfg.as_of)
    order = [quoted(c) for c in clean.columns]
    clean, kept = observed(clean.drop(*RATES), clean_measures())
    folder = scratch_folder(spark, "statistics")
    clean = stored(clean, folder)

    def rated(rows: DataFrame) -> DataFrame:
        return with_rates(rows).select(*order)

    days = clean.select("region", "trending_date_parsed").distinct()
    log_changes(days, cfg.changes)
    if cfg.statistics_mode == "merge":
        merge_latest(clean, cfg.statistics, cfg.statistics_partitions, at_rest=True, then=rated)
    elif load:
        if not append_once(clean, cfg.statistics, cfg.loads, load, cfg.statistics_partitions, then=rated):
            log.info("%s has been appended before", load)
    else:
        append(clean, cfg.statistics, cfg.statistics_partitions, then=rated)
    log_changes(days, cfg.changes)
    discard(spark, folder)
    counts = read.get | kept.get
    for name, count in counts.items():
        if count and name.startswith(("null_", "negative_")):
            log.warning("%s: %s rows in %s", name, count, cfg.statistics)
    return counts


def bronze_to_silver(spark: SparkSession, cfg: PipelineConfig) -> dict[str, int]:
    """All raw statistics of the chosen regions into the cleaned statistics table."""
    return load_inputs(raw_inputs(spark, cfg), cfg)


def load_categories(documents: DataFrame, cfg: PipelineConfig, load: str | None = None) -> DataFrame:
    """Write the reference rows of ``documents``; gives a report with one row per file.

    A region's partition is replaced as a whole, so a file that arrives again changes nothing.
    Documents that give no items are set aside as rejected input.
    """
    rows = reference_records(documents, cfg.as_of)
    if has_rows(rows):
        log_names(rows.sparkSession, cfg.changes)
        overwrite_partitions(rows, cfg.reference, ["region"])
        log_names(rows.sparkSession, cfg.changes)
    rejected = refused_documents(documents)
    if has_rows(rejected):
        log.warning("category documents could not be read; see %s", cfg.rejected)
        set_aside(rejected, cfg, load or f"categories-{run_name(cfg)}")
    return document_report(documents)


def reference_to_silver(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """All category documents into the reference table."""
    documents = category_documents(
        spark, cfg.category_path, layout=cfg.category_layout, item=cfg.category_schema
    )
    return load_categories(documents, cfg)
