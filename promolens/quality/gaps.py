"""Days that are missing from the sales: bitmaps of days, and the gaps between the islands in them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def day_bits(scan: DataFrame, *by: str) -> DataFrame:
    """One row per group of ``by`` and month: ``days``, with bit n - 1 set if day n has a line.

    Aggregated before the shuffle, a task passes on one number per group and month, whatever its lines. Keys that name no
    day set no bit.
    """
    key = F.col("DateKey")
    real = scan.filter(F.expr("try_to_date(CAST(DateKey AS STRING), 'yyyyMMdd') IS NOT NULL"))
    bit = F.expr("shiftleft(1, CAST(DateKey % 100 - 1 AS INT))")
    return real.groupBy(*by, F.floor(key / 100).cast("int").alias("month")).agg(F.bit_or(bit).alias("days"))


def date_gaps(scan: DataFrame, *by: str, least: int = 1, expected_keys: tuple[int, int] | None = None) -> DataFrame:
    """Runs of at least ``least`` days without a line: the columns ``by``, ``gap_start``, ``gap_end``, ``gap_days``.

    Gaps lie between two days of a group that have lines, and with ``expected_keys`` also before the first and after the
    last such day. A group's days, at most the calendar's, are ordered in one task; groups without any real day have no
    gaps. Null group keys are a group.
    """
    bits = day_bits(scan, *by)
    days = bits.select(
        *by,
        F.explode(
            F.expr("transform(filter(sequence(1, 31), d -> (days & shiftleft(1, d - 1)) != 0), d -> make_date(month DIV 100, month % 100, d))")
        ).alias("day"),
    )
    if expected_keys is not None:
        first, last = (f"to_date('{key}', 'yyyyMMdd')" for key in expected_keys)
        days = days.filter(F.expr(f"day BETWEEN {first} AND {last}"))
        edges = F.explode(F.expr(f"array(date_sub({first}, 1), date_add({last}, 1))")).alias("day")
        days = days.unionByName(bits.select(*by).distinct().select(*by, edges))
    following = F.lead("day").over(Window.partitionBy(*by).orderBy("day"))
    gaps = days.select(*by, F.date_add("day", 1).alias("gap_start"), F.date_sub(following, 1).alias("gap_end"))
    sized = gaps.withColumns({"gap_days": F.date_diff("gap_end", "gap_start") + 1})
    return sized.filter(F.col("gap_days") >= max(1, least))


def longest_gap(keys: str, first: int | None = None, last: int | None = None) -> str:
    """SQL for the longest run of days that an array of date keys lacks: a struct of days, gap_start and gap_end.

    The latest of equally long ones; zero days if there is none, and null if there are no days at all. With ``first`` and
    ``last`` the run may also lie at either end of that range.
    """
    edges = "" if first is None else f", date_sub(to_date('{first}', 'yyyyMMdd'), 1), date_add(to_date('{last}', 'yyyyMMdd'), 1)"
    known = f"filter(transform({keys}, k -> try_to_date(CAST(k AS STRING), 'yyyyMMdd')), d -> d IS NOT NULL)"
    if first is not None:
        known = f"filter({known}, d -> d BETWEEN to_date('{first}', 'yyyyMMdd') AND to_date('{last}', 'yyyyMMdd'))"
    days = f"array_sort(concat({known}, array({edges.removeprefix(', ')})))" if edges else f"array_sort({known})"
    run = (
        "named_struct('days', CASE WHEN i = 0 THEN 0 ELSE datediff(d, a[i - 1]) - 1 END, "
        "'gap_start', CASE WHEN i = 0 THEN d ELSE date_add(a[i - 1], 1) END, 'gap_end', CASE WHEN i = 0 THEN d ELSE date_sub(d, 1) END)"
    )
    # The sorted days are named once, as the only element of an array that is transformed.
    return f"array_max(transform(array({days}), a -> array_max(transform(a, (d, i) -> {run}))))"
