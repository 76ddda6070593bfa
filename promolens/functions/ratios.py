"""Ratios that are null, never an error, where they are not defined."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double where the denominator is positive."""
    bottom = denominator.cast("double")
    return F.when(bottom > 0, F.try_divide(numerator.cast("double"), bottom))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100


def change_percent(now: Column, base: Column) -> Column:
    return (ratio(now, base) - 1) * 100

