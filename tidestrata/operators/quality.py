"""The quality gate: one aggregation per table, whatever the number of checks.

Every check gives rows of one fixed shape (``schemas.CHECK_RESULT``), so results of several tables
are a table themselves. The whole table is checked unless the rules ask for a sample.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestrata.config import RANGE_CHECKED_TABLE, QualityRules
from tidestrata.functions import instant, instant_value, iso_text, number
from tidestrata.operators.columns import first_present, missing, quoted
from tidestrata.schemas import CHECK_RESULT
from tidestrata.sources.tables import bounded_sample, table

# The check names, in the order they are reported.
CHECKS = ("row_count", "null_pct", "schema", "value_range", "freshness")

# Columns that tell when a record was made, the preferred one first.
TIME_COLUMNS = ("_processed_at", "_ingestion_timestamp")

# The texts of results.
ROW_COUNT_TEXT = "Row count: %d (min: %s)"
NULL_PCT_TEXT = "%s null%%: %.2f%% (max: %s%%)"
NOT_CONFIGURED_TEXT = (
    "No critical columns configured for table '%s' — cannot validate. Add it to CRITICAL_COLUMNS."
)
COLUMN_MISSING_TEXT = "Column '%s' missing from table"
NOTHING_EXPECTED_TEXT = "No expected columns configured for '%s'"
MISSING_TEXT = "Missing columns: %s"
COMPLETE_TEXT = "All expected columns present"
VALUE_RANGE_TEXT = "Views: %d negative, %d extreme (>%s)"
NO_TIME_TEXT = "No timestamp column found — skipping freshness check (backfill data)"
NOT_PARSED_TEXT = "Timestamp column '%s' had no parseable values — skipping"
FRESHNESS_TEXT = "Latest: %s, Cutoff: %s"


@dataclass
class Check:
    """Measures to take in the table's one pass, and result rows to make from them."""

    measures: dict[str, Column] = field(default_factory=dict)
    results: list[Column] = field(default_factory=list)


def result(check: str, table_name: str, **values: Column) -> Column:
    """One row of the result shape; fields not given are null."""
    given = {"check": F.lit(check), "table": F.lit(table_name)} | values
    return F.struct(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CHECK_RESULT]
    )


ROWS = "rows"


def row_count(frame: DataFrame, name: str, rules: QualityRules, now: Column) -> Check:
    rows = F.col(ROWS)
    shown = F.format_string(ROW_COUNT_TEXT, rows, F.lit(str(rules.min_rows)))
    return Check(
        measures={ROWS: F.count(F.lit(1))},
        results=[
            result(
                "row_count",
                name,
                value=rows,
                threshold=F.lit(rules.min_rows),
                passed=rows >= rules.min_rows,
                message=shown,
            )
        ]
    )


def null_pct(frame: DataFrame, name: str, rules: QualityRules, now: Column) -> Check:
    """Missing values per critical column; NaN is missing, an empty text is not."""
    check = Check()
    expected = rules.critical_columns.get(name, ())
    if not expected:
        gap = F.lit(NOT_CONFIGURED_TEXT % name)
        check.results.append(result("null_pct", name, passed=F.lit(False), message=gap))
    kinds = dict(frame.dtypes)
    for place, column in enumerate(expected):
        known = {"column": F.lit(column)}
        if column not in kinds:
            gap = F.lit(COLUMN_MISSING_TEXT % column)
            check.results.append(
                result("null_pct", name, passed=F.lit(False), message=gap, **known)
            )
            continue
        empty = quoted(column).isNull()
        if kinds[column] in ("double", "float"):
            empty = empty | F.isnan(quoted(column))
        key = f"nulls_{place}"
        check.measures |= {ROWS: F.count(F.lit(1)), key: F.count_if(empty)}
        percent = F.coalesce(F.try_divide(F.col(key), F.col(ROWS)) * 100, F.lit(100.0))
        limit = F.lit(str(rules.max_null_pct))
        check.results.append(
            result(
                "null_pct",
                name,
                value=F.bround(percent, 2),
                threshold=F.lit(rules.max_null_pct),
                passed=percent <= rules.max_null_pct,
                message=F.format_string(
                    NULL_PCT_TEXT, F.lit(column), F.bround(percent, 2), limit
                ),
                **known,
            )
        )
    return check


def schema(frame: DataFrame, name: str, rules: QualityRules, now: Column) -> Check:
    expected = rules.critical_columns.get(name, ())
    absent = missing(frame.columns, expected)
    if not expected:
        message = NOTHING_EXPECTED_TEXT % name
    elif absent:
        message = MISSING_TEXT % absent
    else:
        message = COMPLETE_TEXT
    return Check(
        results=[
            result(
                "schema",
                name,
                missing_columns=F.array(*[F.lit(c) for c in absent]),
                passed=F.lit(bool(expected) and not absent),
                message=F.lit(message),
            )
        ]
    )


def value_range(frame: DataFrame, name: str, rules: QualityRules, now: Column) -> Check:
    if name != RANGE_CHECKED_TABLE or "views" not in frame.columns:
        return Check()
    views = F.col("views")
    if dict(frame.dtypes)["views"] not in ("bigint", "int"):
        views = number(views)
    below, above = F.col("below_range"), F.col("above_range")
    ceiling = F.lit(f"{rules.max_views:,}")
    return Check(
        measures={
            "below_range": F.count_if(views < 0),
            "above_range": F.count_if((views > rules.max_views) & ~F.isnan(views.cast("double"))),
        },
        results=[
            result(
                "value_range",
                name,
                column=F.lit("views"),
                negative_count=below,
                extreme_count=above,
                passed=(below == 0) & (above == 0),
                message=F.format_string(VALUE_RANGE_TEXT, below, above, ceiling),
            )
        ],
    )


def freshness(frame: DataFrame, name: str, rules: QualityRules, now: Column) -> Check:
    """The newest record against now minus the allowed hours; a table that cannot tell passes."""
    column = first_present(frame.columns, TIME_COLUMNS)
    if column is None:
        note = F.lit(NO_TIME_TEXT)
        return Check(results=[result("freshness", name, passed=F.lit(True), message=note)])
    newest = F.col("newest")
    cutoff = now - F.make_interval(hours=F.lit(rules.freshness_hours))
    known = newest.isNotNull()
    newest_text, cutoff_text = iso_text(newest, " "), iso_text(cutoff, " ")
    note = F.lit(NOT_PARSED_TEXT % column)
    return Check(
        measures={"newest": F.max(instant_value(quoted(column), frame.schema[column].dataType))},
        results=[
            result(
                "freshness",
                name,
                latest_record=newest_text,
                cutoff=F.when(known, cutoff_text),
                passed=F.coalesce(newest >= cutoff, F.lit(True)),
                message=F.when(
                    known, F.format_string(FRESHNESS_TEXT, newest_text, cutoff_text)
                ).otherwise(note),
            )
        ],
    )


BUILDERS: dict[str, Callable[..., Check]] = {
    builder.__name__: builder for builder in (row_count, null_pct, schema, value_range, freshness)
}


def check_table(
    frame: DataFrame,
    name: str,
    rules: QualityRules | None = None,
    as_of: datetime | None = None,
    checks: Iterable[str] = CHECKS,
) -> DataFrame:
    """The result rows of ``checks`` for one table; only the columns they need are read."""
    rules = rules or QualityRules()
    if rules.sample_rows is not None:
        frame = bounded_sample(frame, rules.sample_rows, rules.sample_key)
    now = instant(as_of)
    built = [BUILDERS[check](frame, name, rules, now) for check in checks]
    measures = {}
    for check in built:
        measures |= check.measures
    results = [row for check in built for row in check.results]
    if not results:
        return frame.sparkSession.createDataFrame([], CHECK_RESULT)
    # Column names alone need no look at the rows.
    taken = frame.agg(*[measure.alias(key) for key, measure in measures.items()]) if measures else (
        frame.sparkSession.range(1)
    )
    return taken.select(F.inline(F.array(*results)))


def unreadable(spark: SparkSession, name: str, problem: Exception | str) -> DataFrame:
    row = {f.name: None for f in CHECK_RESULT}
    row |= {"check": "read_table", "table": name, "passed": False, "message": str(problem)}
    return spark.createDataFrame([row], CHECK_RESULT)


def check_tables(
    spark: SparkSession,
    tables: Mapping[str, str],
    rules: QualityRules | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """Results for catalogue tables, given as check name -> full table name.

    A table may fail while it is read, not only when it is looked up. So each table's checks are
    run here, and a failure becomes a result row; what is kept is a handful of rows per table.
    """
    results = []
    for name, full_name in tables.items():
        try:
            rows = check_table(table(spark, full_name), name, rules, as_of).collect()
            results.append(spark.createDataFrame(rows, CHECK_RESULT))
        except Exception as problem:  # whatever keeps the table from being read
            results.append(unreadable(spark, name, problem))
    return reduce(DataFrame.unionByName, results)


def verdict(results: DataFrame) -> DataFrame:
    """One row: whether all checks passed, how many did, and the results themselves."""
    return results.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("quality_passed"),
        F.count_if("passed").alias("checks_passed"),
        F.count(F.lit(1)).alias("checks_total"),
        F.collect_list(F.struct(*CHECK_RESULT.fieldNames())).alias("details"),
    )
