"""Fail-fast checks: each runs one job and raises ``AssertionError`` naming the first violation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.quality import layers


def require(checks: DataFrame, names: Sequence[str]) -> None:
    failed = checks.filter(F.col("check_name").isin(*names) & ~F.col("passed")).collect()
    messages = {row["check_name"]: row["message"] for row in failed}
    for name in names:
        if name in messages:
            raise AssertionError(f"{name}: {messages[name]}")


def validate_discount_columns(df: DataFrame) -> DataFrame:
    require(
        layers.check_discount_flags(df),
        ["discount_columns_present", "no_negative_smp", "no_negative_mp", "no_negative_cpn", "is_promo_valid"],
    )
    return df


def validate_loyalty_derivation(everyone: DataFrame, valid: DataFrame) -> DataFrame:
    require(
        layers.check_loyalty_derivation(everyone, valid),
        ["no_null_loyalty_codes", "no_empty_loyalty_codes", "codes_start_with_submitter"],
    )
    return valid


def validate_promo_windows(df: DataFrame) -> DataFrame:
    require(
        layers.check_promo_windows(df),
        ["no_negative_durations", "start_before_end", "before_window_correct", "after_window_correct",
         "duration_consistent"],
    )
    return df


def validate_overlap_detection(promos: DataFrame, windows: DataFrame) -> DataFrame:
    require(
        layers.check_overlap_detection(promos, windows),
        ["row_count_preserved", "before_overlap_valid", "after_overlap_valid", "null_dates_when_invalid",
         "null_after_dates_when_invalid", "before_dates_when_valid", "after_dates_when_valid"],
    )
    return windows


def validate_tagged_transactions(tagged: DataFrame) -> DataFrame:
    require(
        layers.check_tagged_transactions(tagged),
        ["valid_period_values", "no_null_periods", "no_null_loyalty_codes", "no_null_outlets",
         "no_negative_volumes"],
    )
    return tagged


def validate_metrics(metrics: DataFrame) -> DataFrame:
    require(
        layers.check_final_metrics(metrics),
        ["no_null_outlets", "no_null_promos", "no_null_brands", "no_null_dates", "no_negative_during_volume"],
    )
    return metrics
