from __future__ import annotations

import random
from datetime import date
from decimal import Decimal

import pytest

from promolens.operators import metrics
from promolens.operators.overlap import detect_overlaps
from promolens.schemas import METRICS, PERIODS, PROMO_KEYS
from tests.conftest import bag
from tests.helpers import chain

TAGGED = """OutletIdentifier string, ReportingBrandName string, PromotionName string,
    PromoTrueStartDate_dt date, PromoTrueEndDate_dt date, LoyaltyCode string,
    MetricVolume decimal(18,2), MetricValue decimal(18,2), period string"""
PROMO = ("000042", "Alba", "Spring", date(2025, 4, 1), date(2025, 9, 29))


def tagged(spark, rows):
    """Rows of (period, customers, volume, value): amounts spread over the customers."""
    lines = []
    for period, customers, volume, value in rows:
        for i in range(customers):
            first = i == 0
            lines.append((*PROMO, f"c{i}", Decimal(volume if first else 0), Decimal(value if first else 0), period))
    return spark.createDataFrame(lines, TAGGED)


BEFORE, DURING, AFTER = ("before_promo", 45, 1153, 8579), ("during_promo", 230, 5000, 12000), ("after_promo", 45, 800, 2000)


def test_worked_example(spark):
    row = metrics.calculate_metrics(tagged(spark, [BEFORE, DURING]), save_to_table=False).first()
    assert (row.before_promo_total_volume, row.during_promo_total_value) == (1153, 12000)
    assert (row.before_promo_total_loyalty_customers, row.during_promo_total_loyalty_customers) == (45, 230)
    assert [row[f"after_promo_{m}"] for m in METRICS] == [None] * 3
    assert round(row.volume_lift_pct, 2) == 333.65
    assert round(row.value_per_loyal_customer_during, 2) == 52.17
    assert row.customer_retention_rate is None
    full = metrics.calculate_metrics(tagged(spark, [BEFORE, DURING, AFTER]), save_to_table=False).first()
    assert round(full.customer_retention_rate, 2) == 19.57


@pytest.mark.parametrize("rows", [[AFTER], [("before_promo", 1, 0, 0), DURING], [BEFORE]])
def test_ratios_are_null_where_undefined(spark, rows):
    row = metrics.calculate_metrics(tagged(spark, rows), save_to_table=False).first()
    assert row.volume_lift_pct is None


def test_column_names_and_order(spark):
    wide = metrics.calculate_metrics(tagged(spark, [DURING]), include_derived=False, save_to_table=False)
    assert wide.columns == [*PROMO_KEYS, *(f"{p}_{m}" for p in PERIODS for m in METRICS)]


def test_rollup_equals_long_then_pivot(spark):
    """Random rows with null codes and amounts; a third of them of one promotion and customer."""
    rng = random.Random(3)
    rows = []
    for i in range(600):
        promo = "hot" if i % 3 == 0 else f"P{rng.randrange(12)}"
        code = "whale" if i % 3 == 0 else rng.choice([None, *(f"c{j}" for j in range(9))])
        amount = rng.choice([None, Decimal(rng.randrange(-5, 90))])
        rows.append((*PROMO[:2], promo, *PROMO[3:], code, amount, amount, rng.choice(PERIODS)))
    df = spark.createDataFrame(rows, TAGGED)
    direct = metrics.widen_rollup(metrics.rollup_by_customer(df))
    stepwise = metrics.pivot_to_wide_format(metrics.aggregate_by_period(df))
    assert bag(direct) == bag(stepwise)
    assert direct.columns == stepwise.columns


def test_promos_without_sales_on_request(spark, settings):
    windows = detect_overlaps(chain(spark, settings), settings)
    wide = metrics.calculate_metrics(tagged(spark, [DURING]), save_to_table=False)
    listed = metrics.keep_all_promos(wide, windows)
    assert listed.count() == 4 and listed.filter("during_promo_total_volume IS NULL").count() == 4


def test_saving_validates_first(spark):
    good = tagged(spark, [BEFORE, DURING])
    metrics.calculate_metrics(good, table_name="saved_metrics")
    assert spark.table("saved_metrics").count() == 1
    bad = spark.createDataFrame([(None, *PROMO[1:], "c", Decimal(1), Decimal(1), "during_promo")], TAGGED)
    with pytest.raises(AssertionError, match="no_null_outlets"):
        metrics.calculate_metrics(bad, table_name="saved_metrics")
    assert spark.table("saved_metrics").first().OutletIdentifier == "000042"
