"""Volume, value and distinct customers per promotion and period, and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.config import DEFAULT_METRICS_TABLE
from promolens.functions.ratios import change_percent, percent, ratio
from promolens.quality.guards import guard_metrics, violations
from promolens.schemas import METRICS, PERIODS, PLACE_KEYS, PROMO_KEYS
from promolens.sources.sink import save_metrics


def aggregate_by_period(tagged: DataFrame) -> DataFrame:
    """Long form: one row per promotion and period."""
    return tagged.groupBy(*PROMO_KEYS, "period").agg(
        F.sum("MetricVolume").alias("total_volume"),
        F.sum("MetricValue").alias("total_value"),
        F.count_distinct("LoyaltyCode").alias("total_loyalty_customers"),
    )


def pivot_to_wide_format(long: DataFrame) -> DataFrame:
    """Wide form of the long one: a column per period and metric, null where there is no row.

    There is one long row per cell, so any aggregate that skips nulls reads it; conditional
    ones do so in a single aggregation.
    """
    cells = {
        f"{period}_{metric}": F.max(F.when(F.col("period") == period, F.col(metric)))
        for period in PERIODS
        for metric in METRICS
    }
    return long.groupBy(*PROMO_KEYS).agg(*(cell.alias(name) for name, cell in cells.items()))


def rollup_by_customer(tagged: DataFrame) -> DataFrame:
    """One row per promotion, period and customer: what all later results are sums of.

    The shuffle is on the customer too, and rows are combined before it, so neither a
    promotion nor a customer that most transactions belong to fills a single task.
    """
    return tagged.groupBy(*PROMO_KEYS, "period", "LoyaltyCode").agg(*_sums())


# Levels of the accounts: one customer of a promotion and period, or one place and period.
CUSTOMER, PLACE = "customer", "place"


def rollup_with_ledger(tagged: DataFrame) -> DataFrame:
    """The rows of :func:`rollup_by_customer`, and beside them a ledger: the same sums per place and period.

    ``level`` says which a row is. Both come out of one aggregation of one pass, whose shuffle counts every transaction
    once whatever tasks are repeated. A ledger row is a plain sum, so ledgers of parts of the sales add up to that of
    all, in any order, and so do those of places to any wider group.
    """
    keys = [*PROMO_KEYS, "period", "LoyaltyCode"]
    sets = tagged.groupingSets([keys, [*PLACE_KEYS, "period"]], *keys)
    level = F.when(F.grouping("LoyaltyCode") == 0, CUSTOMER).otherwise(PLACE)
    return sets.agg(*_sums(), level.alias("level"))


def rollup_of(accounts: DataFrame) -> DataFrame:
    return accounts.filter(F.col("level") == CUSTOMER).drop("level")


def ledger_of(accounts: DataFrame) -> DataFrame:
    names = [c for c in accounts.columns if c not in ("level", "LoyaltyCode", *PROMO_KEYS) or c in PLACE_KEYS]
    return accounts.filter(F.col("level") == PLACE).select(*names)


def _sums() -> list[Column]:
    return [
        F.sum("MetricVolume").alias("MetricVolume"),
        F.sum("MetricValue").alias("MetricValue"),
        F.count("*").alias("tagged_rows"),
        F.count_if(F.col("MetricVolume") < 0).alias("negative_volume_rows"),
        F.count_if(F.col("MetricValue") < 0).alias("negative_value_rows"),
    ]


def widen_rollup(rollup: DataFrame) -> DataFrame:
    """Wide metrics straight from the customer rollup, in one more aggregation.

    Each customer is one row per promotion and period, so counting rows with a code counts
    distinct customers exactly.
    """
    measures = {
        "total_volume": F.col("MetricVolume"),
        "total_value": F.col("MetricValue"),
        "total_loyalty_customers": F.col("LoyaltyCode").isNotNull().cast("long"),
    }
    cells = {
        f"{period}_{metric}": F.sum(F.when(F.col("period") == period, measure))
        for period in PERIODS
        for metric, measure in measures.items()
    }
    return rollup.groupBy(*PROMO_KEYS).agg(*(cell.alias(name) for name, cell in cells.items()))


def add_derived_metrics(wide: DataFrame) -> DataFrame:
    """Volume lift, customer retention and value per customer, null where not calculable."""
    customers = F.col("during_promo_total_loyalty_customers")
    return wide.withColumns(
        {
            "volume_lift_pct": change_percent(
                F.col("during_promo_total_volume"), F.col("before_promo_total_volume")
            ),
            "customer_retention_rate": percent(
                F.col("after_promo_total_loyalty_customers"), customers
            ),
            "value_per_loyal_customer_during": ratio(F.col("during_promo_total_value"), customers),
        }
    )


def keep_all_promos(wide: DataFrame, windows: DataFrame) -> DataFrame:
    """Also list promotions no transaction was tagged for, with null metrics."""
    return windows.select(*PROMO_KEYS).join(wide, list(PROMO_KEYS), "left")


def calculate_metrics(
    tagged: DataFrame,
    include_derived: bool = True,
    save_to_table: bool = True,
    table_name: str = DEFAULT_METRICS_TABLE,
) -> DataFrame:
    """Wide metrics of tagged transactions, optionally derived and saved.

    Saving starts jobs: the result is computed once into a new location of the table, where the first row that breaks a
    check stops the write, and only then replaces the rows of ``table_name``, from which it is returned.
    """
    metrics = widen_rollup(rollup_by_customer(tagged))
    if include_derived:
        metrics = add_derived_metrics(metrics)
    if not save_to_table:
        return metrics
    with violations():
        save_metrics(guard_metrics(metrics), table_name)
    return metrics.sparkSession.table(table_name).select(*metrics.columns)
