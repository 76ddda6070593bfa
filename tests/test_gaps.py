from __future__ import annotations

import random
from datetime import date, timedelta

import pytest

from promolens.quality import gaps, layers
from tests.helpers import key
from tests.test_quality import dimensions, failed

FIRST = date(2025, 1, 1)


def sales(spark, rows):
    """Lines of (outlet, day or bad key)."""
    keys = [(o, d if isinstance(d, int) or d is None else key(d)) for o, d in rows]
    return spark.createDataFrame(keys, "OutletKey long, DateKey int").selectExpr(
        "OutletKey", "1L AS ProductKey", "DateKey", "CAST(0 AS DECIMAL(18,4)) AS SMP_discount", "CAST(0 AS DECIMAL(18,4)) AS MP_discount",
        "CAST(0 AS DECIMAL(18,4)) AS CPN_discount", "0 AS is_promo")


def every_day(days, without=()):
    return [d for k in range(days) if (d := FIRST + timedelta(days=k)) not in without]


def plain(days, first=None, last=None):
    """Runs of missing days, one day at a time."""
    have = {d for d in days if first is None or first <= d <= last}
    if not have and first is None:
        return []
    day, end = (min(have), max(have)) if first is None else (first, last)
    out, run = [], None
    while day <= end + timedelta(days=1):
        if day <= end and day not in have:
            run = run or day
        elif run:
            out.append((run, day - timedelta(days=1), (day - run).days))
            run = None
        day += timedelta(days=1)
    return out


def test_a_missing_month_fails_and_is_named(spark, settings):
    june = {date(2025, 6, 1) + timedelta(days=k) for k in range(30)}
    whole, cut = every_day(365), every_day(365, june)
    for days, expected in ((whole, []), (cut, ["dates_without_gaps"])):
        scan = sales(spark, [(1, d) for d in days])
        for checks in (layers.check_source_data(scan, *dimensions(spark), settings), layers.check_scan(scan, *dimensions(spark), settings)):
            assert failed(checks) == expected
    row = checks.filter("check_name = 'dates_without_gaps'").first()
    assert row.value == 30 and "from 2025-06-01 to 2025-06-30" in row.message
    assert [tuple(r) for r in gaps.date_gaps(scan).collect()] == [(date(2025, 6, 1), date(2025, 6, 30), 30)]


def test_gaps_at_the_ends_of_the_expected_range(spark, settings):
    scan = sales(spark, [(1, d) for d in every_day(60)])
    for expected, wrong in (((20250101, 20250301), []), ((20241201, 20250301), ["date_range_covered", "dates_without_gaps"]), ((20250101, 20250401), ["date_range_covered", "dates_without_gaps"])):
        assert failed(layers.check_source_data(scan, *dimensions(spark), settings, expected)) == wrong
    assert [tuple(r) for r in gaps.date_gaps(scan, expected_keys=(20241201, 20250401)).orderBy("gap_start").collect()] == [
        (date(2024, 12, 1), date(2024, 12, 31), 31),
        (date(2025, 3, 2), date(2025, 4, 1), 31),
    ]


@pytest.mark.parametrize("expected", [None, (20250110, 20250420)])
def test_gaps_of_outlets(spark, expected):
    rng = random.Random(7)
    rows = [(o, FIRST + timedelta(days=rng.randrange(130))) for o in (1, 2, None) for _ in range(40)]
    rows += [(3, FIRST), (4, 20250230), (4, None), (5, 20250115), (5, 20250132)] + [(1, FIRST)] * 500
    bounds = [date(2025, 1, 10), date(2025, 4, 20)] if expected else []
    want = []
    for outlet in {o for o, _ in rows}:
        days = [d if isinstance(d, date) else date(2025, 1, 15) for o, d in rows if o == outlet and (isinstance(d, date) or d == 20250115)]
        if days:
            want += [(outlet, *g) for g in plain(days, *bounds) if g[2] >= 3]
    got = gaps.date_gaps(sales(spark, rows), "OutletKey", least=3, expected_keys=expected)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr) and want


def test_no_days(spark, settings):
    empty = sales(spark, [(1, None), (2, 0)])
    assert gaps.date_gaps(empty).count() == 0 and gaps.date_gaps(empty.limit(0), "OutletKey").count() == 0
    assert "dates_without_gaps" not in failed(layers.check_source_data(empty, *dimensions(spark), settings))
    assert "dates_without_gaps" in failed(layers.check_source_data(empty, *dimensions(spark), settings, (20250101, 20250201)))
    assert failed(layers.check_source_data(sales(spark, [(1, FIRST)]), *dimensions(spark), settings)) == []


def test_bits_are_combined_before_the_shuffle(spark):
    text = gaps.day_bits(sales(spark, [(1, FIRST)]), "OutletKey")._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in text
