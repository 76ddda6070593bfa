"""Summaries of each stage, as DataFrames. Shares of an empty frame are null."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.quality.core import column, percent
from promolens.schemas import BRAND, OUTLET, PROMO, PROMO_KEYS, START


def _share(part: str, whole: str, name: str) -> str:
    return f"round({percent(part, whole)}, 6) AS {name}"


def discount_summary(df: DataFrame) -> DataFrame:
    """Lines in all and by kind of discount."""
    counts = df.selectExpr(
        "count(*) AS total_transactions",
        "count_if(SMP_discount > 0) AS smp_transactions",
        "count_if(MP_discount > 0) AS mp_transactions",
        "count_if(CPN_discount > 0) AS cpn_transactions",
        "count_if(is_promo = 1) AS promo_transactions",
    )
    return counts.selectExpr("*", _share("promo_transactions", "total_transactions", "promo_pct"))


def loyalty_summary(lines: DataFrame) -> DataFrame:
    """Lines with and without a loyalty code, and distinct customers, from the full set."""
    counts = lines.selectExpr(
        "count(*) AS total_transactions",
        "count(LoyaltyCode) AS valid_loyalty",
        "count_if(LoyaltyCode IS NULL) AS no_loyalty",
        "count(DISTINCT LoyaltyCode) AS unique_customers",
    )
    return counts.selectExpr("*", _share("valid_loyalty", "total_transactions", "derivation_rate"))


def promo_windows_summary(promos: DataFrame) -> DataFrame:
    """Promotions, their durations, and how many have data on either side."""
    counts = promos.selectExpr(
        "count(*) AS total_promotions",
        "round(avg(promo_duration_days), 6) AS avg_days",
        "min(promo_duration_days) AS min_days",
        "max(promo_duration_days) AS max_days",
        "count_if(before_data_ok) AS before_data_promotions",
        "count_if(after_data_ok) AS after_data_promotions",
    )
    return counts.selectExpr(
        "*",
        _share("before_data_promotions", "total_promotions", "before_data_pct"),
        _share("after_data_promotions", "total_promotions", "after_data_pct"),
    )


def overlap_summary(windows: DataFrame) -> DataFrame:
    """Promotions by which of the two windows was accepted."""
    counts = windows.selectExpr(
        "count(*) AS total_promotions",
        "count_if(has_before_window AND has_after_window) AS both_windows",
        "count_if(has_before_window AND NOT has_after_window) AS before_only",
        "count_if(NOT has_before_window AND has_after_window) AS after_only",
        "count_if(NOT has_before_window AND NOT has_after_window) AS during_only",
    )
    kinds = counts.columns[1:]
    return counts.selectExpr("*", *(_share(kind, "total_promotions", f"{kind}_pct") for kind in kinds))


def validate_specific_outlet(windows: DataFrame, outlet_id: str, brand_name: str) -> DataFrame:
    """All promotions of one outlet and brand with their flags and windows, in time order."""
    chosen = windows.filter((F.col(OUTLET) == outlet_id) & (F.col(BRAND) == brand_name))
    sides = ("before", "after")
    return chosen.select(
        *PROMO_KEYS[2:],
        "promo_duration_days",
        *(f"{side}_overlap" for side in sides),
        *(f"has_{side}_window" for side in sides),
        *(f"{side}_window_{edge}" for side in sides for edge in ("start", "end")),
    ).orderBy(START, PROMO)


def tagging_summary(tagged: DataFrame) -> DataFrame:
    """Transactions, outlets, customers and totals per period, and of all periods together.

    Takes tagged transactions or their rollup by customer. Rows are first combined per
    outlet and customer, so that both distinct counts work on the smaller set.
    """
    rows = "sum(tagged_rows)" if "tagged_rows" in tagged.columns else "count(*)"
    visits = tagged.groupBy("period", OUTLET, "LoyaltyCode").agg(
        F.expr(f"{rows} AS visit_rows"),
        F.expr("sum(MetricVolume) AS volume"),
        F.expr("sum(MetricValue) AS value"),
    )
    summary = visits.rollup("period").agg(
        F.expr("sum(visit_rows) AS transactions"),
        F.expr(f"count(DISTINCT {OUTLET}) AS unique_outlets"),
        F.expr("count(DISTINCT LoyaltyCode) AS unique_customers"),
        F.expr("sum(volume) AS total_volume"),
        F.expr("sum(value) AS total_value"),
        F.expr("grouping(period) AS overall"),
    )
    label = F.expr("CASE overall WHEN 1 THEN 'all_periods' ELSE period END")
    return summary.withColumns({"period": label}).drop("overall").orderBy("period")


def metrics_summary(metrics: DataFrame) -> DataFrame:
    """Promotions with before and after metrics, average lift and retention."""
    lift, retention = column(metrics, "volume_lift_pct"), column(metrics, "customer_retention_rate")
    counts = metrics.selectExpr(
        "count(*) AS total_promotions",
        "count(before_promo_total_volume) AS with_before",
        "count(after_promo_total_volume) AS with_after",
        f"round(avg(CAST({lift} AS DOUBLE)), 6) AS avg_volume_lift",
        f"round(avg(CAST({retention} AS DOUBLE)), 6) AS avg_retention",
    )
    return counts.selectExpr(
        "*",
        _share("with_before", "total_promotions", "with_before_pct"),
        _share("with_after", "total_promotions", "with_after_pct"),
    )


def top_brands(metrics: DataFrame, k: int | None = None) -> DataFrame:
    """Brands by volume during their promotions, the first ``k`` or all.

    Customers are added up over promotions, so one who bought in two counts twice.
    """
    brands = metrics.groupBy(BRAND).agg(
        F.sum("during_promo_total_volume").alias("total_volume"),
        F.sum("during_promo_total_value").alias("total_value"),
        F.sum("during_promo_total_loyalty_customers").alias("total_customers"),
    )
    ranked = brands.orderBy(F.desc("total_volume"), BRAND)
    return ranked if k is None else ranked.limit(k)


def sample(metrics: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows by promotion key."""
    return metrics.orderBy(*PROMO_KEYS).limit(rows)
