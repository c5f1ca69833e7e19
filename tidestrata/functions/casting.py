"""Casts that give null for a bad value, also in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, TimestampType


#: A time's zone at its end.
ZONE = r":\d.*(Z|UTC|GMT|[+-]\d\d?(:?\d\d)?|[A-Za-z]+/\w+)\s*$"


def text(value: Column) -> Column:
    return value.cast("string")


def whole_number(value: Column, found: DataType | None = None) -> Column:
    """A bigint; a fraction is cut off (``'12.7'`` -> 12), anything else bad is null.

    ``found`` is the type of ``value``. Numbers are cast as they are: as text, a double of ten
    million would be ``1.0E7``. Of text, the second branch only runs for values the plain cast
    rejects. It drops the fraction as text, so numbers above 2^53 stay exact.
    """
    if isinstance(found, NumericType):
        return value.try_cast("bigint")
    as_text = value.cast("string")
    return F.coalesce(
        as_text.try_cast("bigint"),
        F.regexp_replace(as_text, r"\.\d*\s*$", "").try_cast("bigint"),
    )


def flag(value: Column) -> Column:
    return value.cast("string").try_cast("boolean")


def number(value: Column) -> Column:
    return value.try_cast("double")


def instant_value(value: Column, found: DataType | None = None) -> Column:
    """A timestamp from a timestamp or from ISO text; bad text is null.

    ``found`` is the type of ``value``. A time that names no zone is UTC, whatever the session's.
    """
    if isinstance(found, (TimestampType, NumericType)):
        return value.try_cast("timestamp")
    naive = value.try_cast("timestamp_ntz")
    here = F.convert_timezone(F.lit("UTC"), F.current_timezone(), naive).try_cast("timestamp")
    zoned = value.cast("string").rlike(ZONE)
    return F.when(zoned, value.cast("string").try_cast("timestamp")).otherwise(here)
