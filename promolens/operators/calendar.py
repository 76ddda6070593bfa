"""Totals by week, month and over all days, from one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.functions.dates import date_from_key

WEEK, MONTH, ALL = "week", "month", "all"


def calendar_rollup(lines: DataFrame, first_key: int, last_key: int, by: Sequence[str] = (), date_col: str = "DateKey") -> DataFrame:
    """Lines, volume and value of each group of ``by`` per week (from Monday), per month, and in all, between two date keys, both
    included.

    ``level`` is week, month or all; ``level_start`` and ``level_end`` bound the part of it that lies in the range, ``days`` is its
    length, and ``partial`` marks weeks and months that the range cuts, whose totals are not to be compared with whole ones.
    Each level adds up to the same totals; a week or month without lines has no row. Lines are first summed per day, so that the levels are made of at most a row a
    group and day, whatever a group's lines. Keys that name no day are left out, as are days outside the range.
    """
    first, last = (date_from_key(F.lit(k)) for k in (first_key, last_key))
    inside = lines.filter(F.col(date_col).between(first_key, last_key))
    days = inside.groupBy(*by, date_from_key(F.col(date_col)).alias("day")).agg(
        F.count("*").alias("lines"), F.sum("MetricVolume").alias("volume"), F.sum("MetricValue").alias("value")
    )
    dated = days.filter("day IS NOT NULL").withColumns(
        {"week": F.to_date(F.date_trunc("week", "day")), "month": F.to_date(F.date_trunc("month", "day"))}
    )
    sums = dated.groupingSets([[*by, "week"], [*by, "month"], list(by)], *by, "week", "month").agg(
        F.sum("lines").alias("total_lines"), F.sum("volume").alias("total_volume"), F.sum("value").alias("total_value"),
        F.when(F.grouping("week") == 0, WEEK).when(F.grouping("month") == 0, MONTH).otherwise(ALL).alias("level"),
    )
    begin = F.coalesce("week", "month", first)
    end = F.when(F.col("level") == WEEK, F.date_add("week", 6)).when(F.col("level") == MONTH, F.last_day("month")).otherwise(last)
    bounded = sums.withColumns({"begin": begin, "end": end})
    level_start, level_end = F.greatest("begin", first), F.least("end", last)
    return bounded.select(
        *by, "level", level_start.alias("level_start"), level_end.alias("level_end"),
        (F.datediff(level_end, level_start) + 1).alias("days"),
        ((F.col("begin") < first) | (F.col("end") > last)).alias("partial"),
        "total_lines", "total_volume", "total_value",
    )
