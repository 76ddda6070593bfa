"""Small frames for the tests."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from promolens.operators.promo_windows import build_promo_windows

RATES = """OutletIdentifier string, PromotionName string, ReportingBrandName string,
    PromotionRateStartDateKey int, PromotionRateEndDateKey int"""
LOYALTY = """OutletIdentifier string, ReportingBrandName string, DateKey int, LoyaltyCode string,
    MetricVolume decimal(18,2), MetricValue decimal(18,2)"""


def key(day: date) -> int:
    return int(day.strftime("%Y%m%d"))


def span(start: date, days: int) -> tuple[int, int]:
    return key(start), key(start + timedelta(days=days - 1))


def promos(spark: SparkSession, rows: list[tuple], settings) -> DataFrame:
    """Candidate windows of (outlet, promo, brand, start key, end key) rates."""
    return build_promo_windows(spark.createDataFrame(rows, RATES), settings)


def chain(spark: SparkSession, settings) -> DataFrame:
    """Four promotions in a row at one outlet and brand."""
    return promos(
        spark,
        [
            ("000042", "P1", "Alba", 20250702, 20251230),
            ("000042", "P2", "Alba", 20251231, 20260331),
            ("000042", "P3", "Alba", 20260401, 20260630),
            ("000042", "P4", "Alba", 20260701, 20260929),
        ],
        settings,
    )
