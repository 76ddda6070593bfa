"""Loyalty codes and brand names of enriched scan lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.config import DEFAULT_BRAND_RULES
from promolens.functions.loyalty import (
    customer_code,
    known_card,
    known_submitter,
    standard_brand,
)
from promolens.operators.sizes import broadcast_if_small

BrandRules = Sequence[tuple[str, str, str]]

def is_valid_loyalty_number(df: DataFrame) -> DataFrame:
    """``is_valid_loyalty``: the card number is present and not a placeholder."""
    return df.withColumns({"is_valid_loyalty": known_card()})


def is_valid_submitter(df: DataFrame) -> DataFrame:
    """``is_valid_submitter``: the chain that submitted the line is known."""
    return df.withColumns({"is_valid_submitter": known_submitter()})


def derive_loyalty_code(df: DataFrame, separator: str = "") -> DataFrame:
    """``LoyaltyCode``: customer within chain, null where it cannot be told."""
    return df.withColumns({"LoyaltyCode": customer_code(separator)})


def filter_valid_loyalty(df: DataFrame) -> DataFrame:
    return df.filter(F.col("LoyaltyCode").isNotNull())


def standardise_brand_names(df: DataFrame, rules: BrandRules = DEFAULT_BRAND_RULES) -> DataFrame:
    """Rewrite ``ReportingBrandName`` by (reporting brand, brand) rules; the first match wins."""
    return df.withColumns({"ReportingBrandName": standard_brand(rules)}) if rules else df


def standardise_promo_brands(
    promo: DataFrame, product: DataFrame, rules: BrandRules = DEFAULT_BRAND_RULES, broadcast_rows: int = 0
) -> DataFrame:
    """The same for promotion rates, whose brand is that of their product.

    Loyalty lines and promotions meet by brand, so what renames one side must rename the other. A rate of an unknown
    product keeps its name.
    """
    if not rules:
        return promo
    brands = broadcast_if_small(product.select("ProductKey", "Brand"), broadcast_rows)
    return standardise_brand_names(promo.drop("Brand").join(brands, "ProductKey", "left"), rules).select(*promo.columns)


def process_loyalty_data(
    df: DataFrame, rules: BrandRules = DEFAULT_BRAND_RULES, separator: str = ""
) -> tuple[DataFrame, DataFrame]:
    """All lines with their code, and the lines that have one.

    The second set filters the inputs of the code rather than the code itself: the same
    rows, but the conditions then reach the file scans, and a left join that brought in the
    submitter becomes an inner one.
    """

    def finish(rows: DataFrame) -> DataFrame:
        return standardise_brand_names(derive_loyalty_code(rows, separator), rules)

    return finish(df), finish(df.filter(known_card() & known_submitter()))
