"""Regions, from columns and from file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidestrata.schemas import UNKNOWN_REGION

# Fixed value: the first path segment that names a region, up to a second equals sign.
REGION_SEGMENT = r"(?:^|/)region=([^/=]*)"


def plain_region(value: Column) -> Column:
    return F.lower(F.trim(value))


def region_of_path(path: Column) -> Column:
    """The value of the first ``region=`` folder of an encoded path, else ``unknown``."""
    decoded = F.coalesce(F.try_url_decode(path), path)
    found = F.regexp_extract(decoded, REGION_SEGMENT, 1)
    return F.when(found != "", found).otherwise(F.lit(UNKNOWN_REGION))
