from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from promolens.operators.calendar import calendar_rollup

LINES = "brand string, DateKey int, MetricVolume decimal(18,2), MetricValue decimal(18,2)"


def lines(spark, n=2000):
    """A third on one day and of one brand; keys that name no day, null brands, days outside the range."""
    days = [20250101 + 100 * (k % 12) + k % 31 for k in range(n)]
    rows = [("hot" if k % 3 == 0 else [None, "x"][k % 2], 20250303 if k % 3 == 0 else days[k], Decimal(k), Decimal(1)) for k in range(n)]
    return spark.createDataFrame(rows, LINES)


def test_levels_agree_and_edges_are_marked(spark):
    got = calendar_rollup(lines(spark), 20250226, 20250610, ["brand"])
    sums = got.groupBy("brand", "level").agg(*(F.sum(c).alias(c) for c in ("total_lines", "total_volume", "total_value")), F.count_if("partial").alias("partial"))
    found = {(r.brand, r.level): r for r in sums.collect()}
    assert {level for _, level in found} == {"week", "month", "all"} and {brand for brand, _ in found} == {"hot", "x", None}
    for brand in ("hot", "x", None):
        assert len({tuple(found[brand, level])[2:5] for level in ("week", "month", "all")}) == 1
    assert found["x", "all"].partial == 0 and found["x", "week"].partial == 2 and found["x", "month"].partial == 2


def test_bounds(spark):
    got = {(r.level, r.level_start): r for r in calendar_rollup(lines(spark), 20250226, 20250610).collect()}
    week = got["week", date(2025, 2, 26)]
    assert (week.level_end, week.days, week.partial) == (date(2025, 3, 2), 5, True)
    assert (got["week", date(2025, 3, 3)].days, got["week", date(2025, 3, 3)].partial) == (7, False)
    assert (got["month", date(2025, 6, 1)].level_end, got["month", date(2025, 6, 1)].partial) == (date(2025, 6, 10), True)
    assert (got["month", date(2025, 5, 1)].days, got["month", date(2025, 5, 1)].partial) == (31, False)
    assert ("month", date(2025, 4, 1)) not in got  # no such line
    assert got["all", date(2025, 2, 26)].days == 105
    assert calendar_rollup(lines(spark), 20300101, 20300201, ["brand"]).count() == 0
