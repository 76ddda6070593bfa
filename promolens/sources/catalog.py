"""Logical table names mapped to catalog tables, files or DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from promolens.schemas import TABLES, conform

Location = str | DataFrame | Callable[[SparkSession], DataFrame]

# Default catalog names.
DEFAULT_LOCATIONS: dict[str, str] = {
    "scan": "your_database.fact_scan_transactions",
    "outlet": "your_database.dim_outlet",
    "product": "your_database.dim_product",
    "date": "your_database.dim_date",
    "outlet_reference": "your_database.dim_outlet_reference",
    "product_reference": "your_database.dim_product_reference",
    "promo_hierarchy": "your_database.promo_hierarchy",
    "promo_master": "your_database.dim_promotion",
    "loyalty_scan": "your_schema.loyalty_scan",
    "single_promo": "your_schema.single_promo",
}


class Catalog:
    """Resolves a logical table to a DataFrame with the expected columns.

    A location is a table name, a parquet path (anything holding a slash), a DataFrame, or
    a function of the session. Nothing is read before a table is asked for.
    """

    def __init__(self, spark: SparkSession, locations: Mapping[str, Location] | None = None):
        self.spark = spark
        self.locations: dict[str, Location] = {**DEFAULT_LOCATIONS, **(locations or {})}

    def table(self, name: str) -> DataFrame:
        location = self.locations[name]
        if isinstance(location, DataFrame):
            df = location
        elif callable(location):
            df = location(self.spark)
        elif "/" in location:
            df = self.spark.read.parquet(location)
        else:
            df = self.spark.table(location)
        return conform(df, TABLES[name], name)
