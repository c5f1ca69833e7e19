"""Derived numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for any rate made from bigint counts, with room left to add up 10^13 of them.
RATE_TYPE = "decimal(30,4)"


def per_hundred_views(*counts: Column, views: Column) -> Column:
    """The counts together per hundred views, to four places; 0 without views."""
    rate = F.round(reduce(F.try_add, counts) / views * 100, 4)
    return F.when(views > 0, rate).otherwise(F.lit(0.0))


def exact_mean(rate: Column) -> Column:
    """The mean of four-place rates, summed as decimals.

    A sum of doubles depends on the order in which partitions arrive. Decimals add up to the
    same value on any number of executors, so a rerun gives the same table.
    """
    exact = rate.cast(RATE_TYPE)
    return F.try_divide(F.sum(exact).cast("double"), F.count(exact))
