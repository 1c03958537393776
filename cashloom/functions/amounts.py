"""Exact money arithmetic on ``decimal(16,2)``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(16,2)"


def instalment_value(total: Column, count: Column, number: Column, *, residue_on_last: bool = False) -> Column:
    """Value of instalment ``number`` of ``count``: the total in equal parts, rounded half up.

    Equal parts need not add up to the total; with ``residue_on_last`` the last one takes
    the difference.
    """
    equal = (total / count).cast(MONEY)
    if not residue_on_last:
        return equal
    return F.when(number == count, (total - equal * (count - 1)).cast(MONEY)).otherwise(equal)


def deviation_percent(actual: Column, expected: Column) -> Column:
    """Absolute deviation of ``actual`` from ``expected`` in percent; NULL where ``expected`` is 0."""
    return F.abs(F.try_divide(actual, expected) - 1) * 100


def within_percent(actual: Column, expected: Column, low: Column, high: Column) -> Column:
    """``deviation_percent(actual, expected) BETWEEN low AND high`` without the division.

    Both sides are multiplied out, so the bounds are met exactly whatever the quotient's
    decimal expansion, and an expected value of 0 matches nothing.
    """
    gap = F.abs(actual - expected) * 100
    size = F.abs(expected)
    return (expected != 0) & (gap >= low * size) & (gap <= high * size)
