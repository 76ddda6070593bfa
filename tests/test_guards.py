from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from promolens.operators.metrics import calculate_metrics
from promolens.operators.overlap import detect_overlaps
from promolens.plans.queries import QUERIES
from promolens.plans.stages import Stages
from promolens.quality import guards, validators
from promolens.quality.guards import violations
from promolens.sources.sample import SETTINGS, sample_catalog
from promolens.sources.sink import save_metrics
from tests.conftest import bag
from tests.helpers import chain
from tests.test_metrics import AFTER, BEFORE, DURING, tagged
from tests.test_quality import scan


def write(df):
    with violations():
        df.write.format("noop").mode("overwrite").save()


def frames(spark, settings):
    promos = chain(spark, settings)
    windows = detect_overlaps(promos, settings)
    sales = tagged(spark, [BEFORE, DURING, AFTER])
    codes = spark.sql("SELECT 'A1' AS LoyaltyCode, 'A' AS SubmitterName UNION ALL SELECT 'B2', 'B' UNION ALL SELECT 'C3', NULL")
    return {
        "discount_columns": scan(spark), "loyalty_derivation": codes, "promo_windows": promos, "overlap_detection": windows,
        "tagged_transactions": sales, "metrics": calculate_metrics(sales, save_to_table=False),
    }


#: What breaks which check: the frame, changed columns, the check.
BROKEN = [
    ("discount_columns", {"SMP_discount": "-1"}, "no_negative_smp"), ("discount_columns", {"MP_discount": "-1"}, "no_negative_mp"),
    ("discount_columns", {"CPN_discount": "-1"}, "no_negative_cpn"), ("discount_columns", {"is_promo": "2"}, "is_promo_valid"),
    ("discount_columns", {"is_promo": "CAST(NULL AS INT)"}, "is_promo_valid"),
    ("loyalty_derivation", {"LoyaltyCode": "nullif(LoyaltyCode, 'B2')"}, "no_null_loyalty_codes"),
    ("loyalty_derivation", {"LoyaltyCode": "replace(LoyaltyCode, 'B2', '')"}, "no_empty_loyalty_codes"),
    ("loyalty_derivation", {"LoyaltyCode": "replace(LoyaltyCode, 'B2', 'A2')"}, "codes_start_with_submitter"),
    ("promo_windows", {"promo_duration_days": "0"}, "no_negative_durations"),
    ("promo_windows", {"PromoTrueEndDate_dt": "PromoTrueStartDate_dt - 1"}, "start_before_end"),
    ("promo_windows", {"before_candidate_end": "PromoTrueStartDate_dt"}, "before_window_correct"),
    ("promo_windows", {"after_candidate_start": "PromoTrueEndDate_dt"}, "after_window_correct"),
    ("promo_windows", {"promo_duration_days": "promo_duration_days + 1"}, "duration_consistent"),
    ("overlap_detection", {"before_overlap": "CAST(NULL AS INT)"}, "before_overlap_valid"),
    ("overlap_detection", {"after_overlap": "2"}, "after_overlap_valid"),
    ("overlap_detection", {"has_before_window": "false", "before_window_start": "DATE '2025-01-01'"}, "null_dates_when_invalid"),
    ("overlap_detection", {"has_after_window": "false", "after_window_end": "DATE '2025-01-01'"}, "null_after_dates_when_invalid"),
    ("overlap_detection", {"has_before_window": "true", "before_window_start": "CAST(NULL AS DATE)"}, "before_dates_when_valid"),
    ("overlap_detection", {"has_after_window": "true", "after_window_end": "CAST(NULL AS DATE)"}, "after_dates_when_valid"),
    ("tagged_transactions", {"period": "'later'"}, "valid_period_values"), ("tagged_transactions", {"period": "CAST(NULL AS STRING)"}, "no_null_periods"),
    ("tagged_transactions", {"LoyaltyCode": "CAST(NULL AS STRING)"}, "no_null_loyalty_codes"),
    ("tagged_transactions", {"OutletIdentifier": "CAST(NULL AS STRING)"}, "no_null_outlets"),
    ("tagged_transactions", {"MetricVolume": "-1"}, "no_negative_volumes"),
    ("metrics", {"OutletIdentifier": "CAST(NULL AS STRING)"}, "no_null_outlets"), ("metrics", {"PromotionName": "CAST(NULL AS STRING)"}, "no_null_promos"),
    ("metrics", {"ReportingBrandName": "CAST(NULL AS STRING)"}, "no_null_brands"), ("metrics", {"PromoTrueEndDate_dt": "CAST(NULL AS DATE)"}, "no_null_dates"),
    ("metrics", {"during_promo_total_volume": "-1"}, "no_negative_during_volume"),
]


def guard(name, df):
    return getattr(guards, f"guard_{name}")(*((df,) if name != "overlap_detection" else (df, df)))


def test_sound_rows_pass_unchanged(spark, settings):
    for name, df in frames(spark, settings).items():
        assert bag(guard(name, df)) == bag(df)


def test_broken_rows_stop_the_job(spark, settings):
    sound = frames(spark, settings)
    for name, changes, check in BROKEN:
        broken = guard(name, sound[name].withColumns({c: F.expr(e) for c, e in changes.items()}))
        with pytest.raises(AssertionError, match=check):
            write(broken)


def test_validators_and_guards_agree(spark, settings):
    sound = frames(spark, settings)
    for name, changes, check in BROKEN:
        df = sound[name].withColumns({c: F.expr(e) for c, e in changes.items()})
        eager = getattr(validators, f"validate_{name}")
        with pytest.raises(AssertionError, match=check):
            eager(*((df,) if name not in ("overlap_detection", "loyalty_derivation") else (df, df)))


def test_missing_columns_and_lost_promotions_raise_at_once(spark, settings):
    with pytest.raises(AssertionError, match="discount_columns_present: Missing columns MP_discount"):
        guards.guard_discount_columns(scan(spark).drop("MP_discount"))
    windows = frames(spark, settings)["overlap_detection"]
    with pytest.raises(AssertionError, match="row_count_preserved"):
        guards.guard_overlap_detection(windows, windows.limit(1))


def test_guard_sees_rows_of_the_result_only(spark):
    """A filter that could move below the join would raise for a row that the join drops."""
    rows = spark.sql("SELECT id, id AS amount FROM range(10)").unionByName(spark.sql("SELECT 99L AS id, -1L AS amount"))
    joined = rows.join(spark.range(10), "id")
    assert guards.guarded(joined, {"positive": "amount >= 0"}).count() == 10
    with pytest.raises(AssertionError, match="positive"):
        write(guards.guarded(rows, {"positive": "amount >= 0"}))


def test_violation_stops_the_write(spark, settings):
    metrics = frames(spark, settings)["metrics"]
    save_metrics(metrics, "guarded_metrics")
    before = bag(spark.table("guarded_metrics"))
    with pytest.raises(AssertionError, match="no_null_brands"), violations():
        save_metrics(guards.guard_metrics(metrics.withColumns({"ReportingBrandName": F.lit(None).cast("string")})), "guarded_metrics")
    assert bag(spark.table("guarded_metrics")) == before
    with pytest.raises(ZeroDivisionError), violations():
        raise ZeroDivisionError


def test_guards_add_no_scan_and_no_job(spark):
    stages = Stages(sample_catalog(spark, "/root/testdata/sf0.001"), SETTINGS)
    stages.kept("windows")
    pairs = {"discounts": stages.scan, "loyalty": stages.loyalty_valid, "windows": stages.kept("promos"), "tagged": stages.tagged, "metrics": stages.metrics}

    def scans(df):
        return df._jdf.queryExecution().executedPlan().toString().count("FileScan")

    for name, plain in pairs.items():
        spark.sparkContext.setJobGroup(f"guard {name}", "")
        with_guard = QUERIES[f"validated_{name}"](stages)
        if name in ("discounts", "windows"):  # the others count dimensions or windows to broadcast them
            assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"guard {name}")
        assert scans(with_guard) == scans(plain)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
