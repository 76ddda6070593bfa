from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from promolens.functions.dates import date_from_key, month_of_date, month_of_key
from promolens.quality.layers import check_promo_windows
from tests.helpers import promos


def test_span_of_several_rates(spark, settings):
    row = promos(
        spark,
        [("O", "P", "B", 20250330, 20250501), ("O", "P", "B", 20250415, 20250628)],
        settings,
    ).first()
    assert (row.PromoTrueStartDate, row.PromoTrueEndDate) == (20250330, 20250628)
    assert (row.DurationWeeks, row.promo_duration_days) == (12, 91)
    assert (row.before_candidate_start, row.before_candidate_end) == (date(2024, 12, 29), date(2025, 3, 29))
    assert (row.after_candidate_start, row.after_candidate_end) == (date(2025, 6, 29), date(2025, 9, 27))
    assert (row.before_data_ok, row.after_data_ok) == (False, True)


def test_bad_date_key_is_null_and_reported(spark, settings):
    df = promos(spark, [("O", "P", "B", 20251399, 20251401)], settings)
    row = df.first()
    assert row.PromoTrueStartDate_dt is None and row.before_data_ok is None
    failed = check_promo_windows(df).filter("NOT passed").collect()
    assert [r.check_name for r in failed] == ["duration_consistent"]


def test_after_data_needs_a_begun_window(spark, settings):
    df = promos(
        spark,
        [("O", "P1", "B", 20261101, 20261130), ("O", "P2", "B", 20261101, 20261201)],
        settings,
    )
    assert {r.PromotionName: r.after_data_ok for r in df.collect()} == {"P1": True, "P2": False}


def test_current_date_is_the_default_today(spark, settings):
    from dataclasses import replace

    today = spark.range(1).select(replace(settings, as_of=None).today.alias("d"), F.current_date().alias("e")).first()
    assert today.d == today.e


def test_month_numbers_agree_and_are_clamped(spark):
    days = spark.createDataFrame(
        [(date(2024, 12, 31),), (date(2025, 1, 1),), (date(2025, 6, 15),), (date(9999, 12, 31),), (date(1990, 5, 5),)],
        "d date",
    ).withColumn("k", F.date_format("d", "yyyyMMdd").cast("int"))
    first, last = F.lit(date(2025, 1, 1)), F.lit(date(2026, 2, 1))
    got = days.select(
        month_of_date(F.col("d"), first, last).alias("a"),
        month_of_key(F.col("k"), F.lit(20250101), F.lit(20260201)).alias("b"),
        date_from_key(F.col("k")).alias("back"),
        "d",
    ).collect()
    assert all(r.a == r.b and r.back == r.d for r in got)
    assert [r.a - 2025 * 12 for r in got] == [1, 1, 6, 14, 1]
