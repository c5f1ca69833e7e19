"""Column functions. All are built on Spark's own expressions; there are no UDFs."""

from tidestrata.functions.casting import flag, instant_value, number, text, whole_number
from tidestrata.functions.dates import (
    day_of_trend,
    instant,
    iso_text,
    trend_text,
    utc_text,
)
from tidestrata.functions.metrics import exact_mean, per_hundred_views
from tidestrata.functions.places import plain_region, region_of_path

__all__ = [
    "day_of_trend",
    "exact_mean",
    "flag",
    "instant",
    "instant_value",
    "iso_text",
    "number",
    "per_hundred_views",
    "plain_region",
    "region_of_path",
    "text",
    "trend_text",
    "utc_text",
    "whole_number",
]
