"""Bringing either raw layout to the one statistics record."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, LongType

from tidestrata.functions import flag, instant, text, trend_text, whole_number
from tidestrata.operators.columns import first_present, quoted, spellings
from tidestrata.schemas import API_DEFAULTS, API_FIELDS, STATISTICS_TYPES


def typed(value: Column, found: DataType, wanted: DataType) -> Column:
    if isinstance(wanted, LongType):
        return whole_number(value, found)
    if isinstance(wanted, BooleanType):
        return flag(value)
    if isinstance(found, ArrayType):
        return F.array_join(value, "|")
    return text(value)


def from_csv(frame: DataFrame) -> DataFrame:
    found = {f.name: f.dataType for f in frame.schema.fields}
    return frame.select(
        *[
            typed(quoted(name), found[name], wanted).alias(name)
            for name, wanted in STATISTICS_TYPES.items()
        ]
    )


def from_api(frame: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Flattened API items; they carry no trending day, so they get the day of the run."""
    found = {f.name: f.dataType for f in frame.schema.fields}

    def value_of(name: str, wanted: DataType) -> Column:
        if name == "trending_date":
            return trend_text(instant(as_of))
        if name == "region":
            return text(F.col("region"))
        here = first_present(frame.columns, spellings(API_FIELDS[name])) if name in API_FIELDS else None
        if here is not None:
            return typed(quoted(here), found[here], wanted)
        if name in API_DEFAULTS:
            return F.lit(API_DEFAULTS[name]).cast(wanted)
        raise ValueError(f"API items have no field for {name}: {frame.columns}")

    return frame.select(*[value_of(n, t).alias(n) for n, t in STATISTICS_TYPES.items()])


def is_api_layout(frame: DataFrame) -> bool:
    return first_present(frame.columns, spellings(API_FIELDS["title"])) is not None


def statistics_record(frame: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The statistics record from whichever layout the column names show."""
    return from_api(frame, as_of) if is_api_layout(frame) else from_csv(frame)
