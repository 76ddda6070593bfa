from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from promolens.operators import tagging
from promolens.operators.overlap import detect_overlaps
from promolens.sources.sink import stage
from tests.conftest import bag
from tests.helpers import LOYALTY, chain, key, promos, span


def sales(spark, *rows):
    return spark.createDataFrame([(o, b, d, c, Decimal(1), Decimal(2)) for o, b, d, c in rows], LOYALTY)


def labels(df):
    return sorted((r.LoyaltyCode, r.PromotionName, r.period) for r in df.collect())


def test_bounds_are_inclusive(spark, settings):
    windows = detect_overlaps(promos(spark, [("O", "P", "B", 20250610, 20250619)], settings), settings)
    loyalty = sales(
        spark,
        *(("O", "B", d, str(d)) for d in (20250530, 20250531, 20250609, 20250610, 20250619, 20250620, 20250629, 20250630)),
        ("O", "other", 20250610, "x"), ("other", "B", 20250610, "y"), (None, "B", 20250610, "z"),
    )
    assert labels(tagging.tag_transactions(loyalty, windows, settings)) == [
        ("20250531", "P", "before_promo"), ("20250609", "P", "before_promo"),
        ("20250610", "P", "during_promo"), ("20250619", "P", "during_promo"),
        ("20250620", "P", "after_promo"), ("20250629", "P", "after_promo"),
    ]


def test_one_sale_can_have_several_labels(spark, settings):
    windows = detect_overlaps(
        promos(
            spark,
            [("O", "A", "B", 20250601, 20250610), ("O", "C", "B", 20250605, 20250620), ("O", "Z", "B", 20250625, 20250626),
             ("Q", "A", "B", 20250601, 20250610), ("Q", "C", "B", 20250631, 20250640), ("R", "A", "B", 20250601, 20250605),
             ("R", "C", "B", 20250616, 20250620)],
            settings,
        ),
        settings,
    )
    loyalty = sales(spark, ("O", "B", 20250607, "two"), ("R", "B", 20250610, "after"), ("R", "B", 20250611, "before"))
    assert labels(tagging.tag_transactions(loyalty, windows, settings)) == [
        ("after", "A", "after_promo"), ("before", "C", "before_promo"),
        ("two", "A", "during_promo"), ("two", "C", "during_promo"),
    ]


def test_bad_keys_are_never_tagged(spark, settings):
    windows = detect_overlaps(promos(spark, [("O", "P", "B", 20251201, 20260315)], settings), settings)
    loyalty = sales(
        spark, ("O", "B", 20251399, "bad"), ("O", "B", 20260230, "feb"), ("O", "B", 20260100, "zero"),
        ("O", "B", None, "null"), ("O", "B", 20260228, "good"),
    )
    assert labels(tagging.tag_transactions(loyalty, windows, settings)) == [("good", "P", "during_promo")]
    dated = tagging.prepare_loyalty_dates(loyalty).collect()
    assert [r.DateKey_dt for r in dated] == [None, None, None, None, date(2026, 2, 28)]


def test_days_outside_the_analysed_range_still_match(spark, settings):
    windows = detect_overlaps(
        promos(spark, [("O", "open", "B", 20240101, 99991231), ("O", "old", "C", 20190101, 20190131)], settings), settings
    )
    loyalty = sales(
        spark, ("O", "B", 20240101, "early"), ("O", "B", 20300101, "late"), ("O", "B", 20231231, "no"),
        ("O", "C", 20190131, "old"), ("O", "C", 20190401, "no"),
    )
    assert labels(tagging.tag_transactions(loyalty, windows, settings)) == [
        ("early", "open", "during_promo"), ("late", "open", "during_promo"), ("old", "old", "during_promo"),
    ]


def test_windows_tables(spark, settings):
    windows = detect_overlaps(chain(spark, settings), settings)
    assert tagging.get_during_windows(windows).count() == 4
    assert [r.PromotionName for r in tagging.get_before_windows(windows).collect()] == ["P1"]
    assert [r.PromotionName for r in tagging.get_after_windows(windows).collect()] == ["P4"]


def random_case(spark, settings, seed):
    rng = random.Random(seed)
    places = [("hot", "B")] * 6 + [(f"O{i}", "B") for i in range(6)]
    rates = []
    for i in range(120):
        start = date(2025, 1, 1) + timedelta(days=rng.randrange(650))
        outlet, brand = rng.choice(places)
        rates.append((outlet, f"P{i}", brand, *span(start, rng.choice([1, 5, 20, 60]))))
    rows = []
    for i in range(900):
        outlet, brand = rng.choice(places)
        rows.append((outlet, brand, key(date(2024, 11, 1) + timedelta(days=rng.randrange(800))), f"c{i % 50}"))
    return sales(spark, *rows), detect_overlaps(promos(spark, rates, settings), settings)


def brute_force(loyalty, windows):
    found = []
    windows = windows.collect()
    for sale in loyalty.collect():
        day = datetime.strptime(str(sale.DateKey), "%Y%m%d").date()
        for w in windows:
            if (w.OutletIdentifier, w.ReportingBrandName) != (sale.OutletIdentifier, sale.ReportingBrandName):
                continue
            spans = [("during_promo", w.PromoTrueStartDate_dt, w.PromoTrueEndDate_dt)]
            if w.has_before_window:
                spans.append(("before_promo", w.before_window_start, w.before_window_end))
            if w.has_after_window:
                spans.append(("after_promo", w.after_window_start, w.after_window_end))
            for period, first, last in spans:
                if first <= day <= last:
                    found.append((sale.LoyaltyCode, w.PromotionName, period))
    return sorted(found)


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("broadcast_rows", [0, 10, 10_000])
def test_equals_pairwise_comparison(spark, settings, seed, broadcast_rows):
    loyalty, windows = random_case(spark, settings, seed)
    tagged = tagging.tag_transactions(loyalty, windows, settings, broadcast_rows=broadcast_rows)
    assert labels(tagged) == brute_force(loyalty, windows)
    assert tagged.columns == list(tagging.TAGGED_COLUMNS)


def test_one_pass_equals_three(spark, settings):
    loyalty, windows = random_case(spark, settings, 7)
    taggers = (tagging.tag_during_transactions, tagging.tag_before_transactions, tagging.tag_after_transactions)
    apart = [tagger(loyalty, windows, settings) for tagger in taggers]
    assert [Counter(r.period for r in df.collect()).keys() for df in apart] == [
        {"during_promo": 1}.keys(), {"before_promo": 1}.keys(), {"after_promo": 1}.keys(),
    ]
    assert bag(tagging.union_all_periods(*apart)) == bag(tagging.tag_transactions(loyalty, windows, settings))


def test_loyalty_may_carry_promotion_columns(spark, settings):
    windows = detect_overlaps(chain(spark, settings), settings)
    loyalty = sales(spark, ("000042", "Alba", 20260115, "c")).selectExpr("*", "'mine' AS PromotionName", "DateKey AS Promo_DateKey")
    tagged = tagging.tag_transactions(loyalty, windows, settings, date_col="Promo_DateKey")
    assert labels(tagged) == [("c", "P2", "during_promo")]


def test_spans_are_shuffled_without_what_their_keys_say(spark, settings, tmp_path):
    loyalty, windows = random_case(spark, settings, 3)
    windows = stage(windows, str(tmp_path), "windows")
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        for periods in (tagging.PERIODS, [tagging.AFTER]):
            tagged = tagging.tag_transactions(loyalty, windows, settings, periods=periods)
            text = spark._jvm.PythonSQLUtils.explainString(tagged._jdf.queryExecution(), "formatted")
            shuffled = [part for part in text.split("\n(") if ") Exchange" in part.splitlines()[0]]
            assert len(shuffled) == 2 and sum("last_key#" in part for part in shuffled) == 1
            assert not any("span_start" in part or "span_end" in part for part in shuffled)
            assert any("period#" in part for part in shuffled) == (len(periods) > 1)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
