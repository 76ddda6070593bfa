"""Validity of loyalty numbers and the chain-scoped customer code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Loyalty numbers that mean "no card".
NO_CARD = ("", "0")


def known_card() -> Column:
    """True or false, never null. Cast first: a numeric column cannot be compared with ''."""
    number = F.col("LoyaltyNumber").cast("string")
    return number.isNotNull() & F.coalesce(~number.isin(*NO_CARD), F.lit(False))


def known_submitter() -> Column:
    return F.col("SubmitterName").isNotNull()


def customer_code(separator: str = "") -> Column:
    """Submitter and number joined, or null if either is not usable.

    The default has no separator, so ('A1', '23') and ('A', '123') share a code; pass one
    to keep them apart.
    """
    parts = [F.col("SubmitterName"), F.col("LoyaltyNumber").cast("string")]
    if separator:
        parts.insert(1, F.lit(separator))
    return F.when(known_card() & known_submitter(), F.concat(*parts))


def standard_brand(rules: Sequence[tuple[str, str, str]]) -> Column:
    """Reporting brand after the first rule whose (reporting brand, brand) pair matches."""
    reporting, brand = F.col("ReportingBrandName"), F.col("Brand")
    name = F
    for old, variant, new in rules:
        name = name.when((reporting == old) & (brand == variant), F.lit(new))
    return name.otherwise(reporting)
