"""True promotion spans and the equally long candidate windows on either side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.config import Settings
from promolens.functions.dates import date_from_key, inclusive_days, whole_weeks
from promolens.schemas import BRAND, END, OUTLET, PROMO, START


def build_promo_result(rates: DataFrame) -> DataFrame:
    """One row per outlet, promotion and brand: first rate start to last rate end.

    Minimum and maximum combine before the shuffle, so a promotion with very many rate rows
    sends one row per task.
    """
    spans = rates.groupBy(OUTLET, PROMO, BRAND).agg(
        F.min("PromotionRateStartDateKey").alias("PromoTrueStartDate"),
        F.max("PromotionRateEndDateKey").alias("PromoTrueEndDate"),
    )
    dated = spans.withColumns(
        {
            START: date_from_key(F.col("PromoTrueStartDate")),
            END: date_from_key(F.col("PromoTrueEndDate")),
        }
    )
    return dated.withColumns({"DurationWeeks": whole_weeks(START, END)})


def add_promo_duration(df: DataFrame) -> DataFrame:
    """``promo_duration_days``: days of the span, both ends counted."""
    return df.withColumns({"promo_duration_days": inclusive_days(START, END)})


def add_before_candidate_window(df: DataFrame) -> DataFrame:
    """As many days as the span has, ending the day before it starts."""
    return df.withColumns(
        {
            "before_candidate_start": F.date_sub(START, F.col("promo_duration_days")),
            "before_candidate_end": F.date_sub(START, 1),
        }
    )


def add_after_candidate_window(df: DataFrame) -> DataFrame:
    """As many days as the span has, starting the day after it ends."""
    return df.withColumns(
        {
            "after_candidate_start": F.date_add(END, 1),
            "after_candidate_end": F.date_add(END, F.col("promo_duration_days")),
        }
    )


def add_data_availability_flags(df: DataFrame, settings: Settings) -> DataFrame:
    """Whether data reaches back to the before window, and the after window has begun."""
    return df.withColumns(
        {
            "before_data_ok": F.col("before_candidate_start") >= settings.first_day,
            "after_data_ok": F.col("after_candidate_start") <= settings.today,
        }
    )


def build_promo_windows(rates: DataFrame, settings: Settings) -> DataFrame:
    """Spans, durations, candidate windows and data flags of all promotions."""
    return (
        build_promo_result(rates)
        .transform(add_promo_duration)
        .transform(add_before_candidate_window)
        .transform(add_after_candidate_window)
        .transform(add_data_availability_flags, settings)
    )
