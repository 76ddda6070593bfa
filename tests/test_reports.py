from __future__ import annotations

from promolens.operators import reports
from promolens.operators.metrics import calculate_metrics, rollup_by_customer
from promolens.operators.overlap import detect_overlaps
from tests.helpers import chain
from tests.test_metrics import AFTER, BEFORE, DURING, tagged


def test_buckets_add_up_in_both_modes(spark, settings):
    row = reports.overlap_summary(detect_overlaps(chain(spark, settings), settings)).first()
    assert row.both_windows + row.before_only + row.after_only + row.during_only == row.total_promotions == 4
    assert (row.before_only, row.after_only, row.during_only_pct) == (1, 1, 50.0)


def test_window_summary(spark, settings):
    row = reports.promo_windows_summary(chain(spark, settings)).first()
    assert (row.total_promotions, row.min_days, row.max_days, row.avg_days) == (4, 91, 182, 113.75)
    assert (row.before_data_promotions, row.after_data_promotions) == (4, 4)


def test_drilldown_is_in_time_order(spark, settings):
    df = reports.validate_specific_outlet(detect_overlaps(chain(spark, settings), settings), "000042", "Alba")
    assert [r.PromotionName for r in df.collect()] == ["P1", "P2", "P3", "P4"]
    assert len(df.columns) == 12


def test_tagging_summary_of_rows_and_rollup(spark):
    df = tagged(spark, [BEFORE, DURING, AFTER])
    rows = reports.tagging_summary(df).collect()
    assert rows == reports.tagging_summary(rollup_by_customer(df)).collect()
    assert [(r.period, r.transactions, r.unique_customers) for r in rows] == [
        ("after_promo", 45, 45), ("all_periods", 320, 230), ("before_promo", 45, 45), ("during_promo", 230, 230),
    ]


def test_metrics_summary_with_and_without_derived(spark):
    df = tagged(spark, [BEFORE, DURING])
    full = reports.metrics_summary(calculate_metrics(df, save_to_table=False)).first()
    assert (full.total_promotions, full.with_before, full.with_after, full.with_before_pct) == (1, 1, 0, 100.0)
    assert round(full.avg_volume_lift, 2) == 333.65 and full.avg_retention is None
    plain = reports.metrics_summary(calculate_metrics(df, include_derived=False, save_to_table=False)).first()
    assert plain.avg_volume_lift is None


def test_top_brands(spark):
    metrics = calculate_metrics(tagged(spark, [DURING]), save_to_table=False)
    more = metrics.selectExpr("* EXCEPT (ReportingBrandName, during_promo_total_volume)", "'Z' AS ReportingBrandName",
                              "during_promo_total_volume * 2 AS during_promo_total_volume")
    both = metrics.unionByName(more)
    assert [r.ReportingBrandName for r in reports.top_brands(both).collect()] == ["Z", "Alba"]
    assert [r.ReportingBrandName for r in reports.top_brands(both, 1).collect()] == ["Z"]
    assert reports.sample(both, 1).count() == 1


def test_summaries_of_nothing(spark):
    lines = spark.createDataFrame([], "SMP_discount int, MP_discount int, CPN_discount int, is_promo int, LoyaltyCode string")
    assert reports.discount_summary(lines).first().promo_pct is None
    row = reports.loyalty_summary(lines).first()
    assert (row.total_transactions, row.unique_customers, row.derivation_rate) == (0, 0, None)
