"""Trending days, run instants, and their text forms.

Instants are shown in UTC, whatever the session's zone is.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# The short form of a trending day (year.day.month) and its shape.
TREND_FORMAT = "yy.dd.MM"
TREND_SHAPE = r"^\d{2}\.\d{2}\.\d{2}$"


def day_of_trend(value: Column) -> Column:
    """The date of a ``yy.dd.MM`` or ISO text, null when it is neither.

    The short form is put in ISO order and cast, which is far cheaper per row than a pattern.
    """
    year, day, month = (F.substring(value, start, 2) for start in (1, 4, 7))
    reordered = F.concat(F.lit("20"), year, F.lit("-"), month, F.lit("-"), day)
    return F.when(value.rlike(TREND_SHAPE), reordered).otherwise(value).try_cast("date")


def instant(as_of: datetime | None) -> Column:
    """A fixed instant for repeatable runs, or the start of the query."""
    if as_of is None:
        return F.current_timestamp()
    aware = as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
    return F.lit(aware.astimezone(timezone.utc).isoformat()).cast("timestamp")


def utc_text(moment: Column, pattern: str) -> Column:
    return F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), pattern)


def trend_text(moment: Column) -> Column:
    return utc_text(moment, TREND_FORMAT)


def iso_text(moment: Column, separator: str = "T") -> Column:
    """``2024-01-31T08:00:00.000123+00:00``; the fraction is left out when it is zero."""
    whole = f"yyyy-MM-dd'{separator}'HH:mm:ss"
    has_fraction = F.unix_micros(moment) % 1_000_000 != 0
    shown = F.when(has_fraction, utc_text(moment, f"{whole}.SSSSSS")).otherwise(
        utc_text(moment, whole)
    )
    return F.concat(shown, F.lit("+00:00"))
