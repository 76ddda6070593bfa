"""Discount classification of scan lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.functions.discounts import (
    any_discount,
    coupon_discount,
    manufacturer_discount,
    multipack_discount,
)


def add_smp_discount(df: DataFrame) -> DataFrame:
    """``SMP_discount``: what the manufacturer pays per line."""
    return df.withColumns({"SMP_discount": manufacturer_discount()})


def add_mp_discount(df: DataFrame) -> DataFrame:
    """``MP_discount``: multipack discount, by who funds it."""
    return df.withColumns({"MP_discount": multipack_discount()})


def add_cpn_discount(df: DataFrame) -> DataFrame:
    """``CPN_discount``: coupon discount."""
    return df.withColumns({"CPN_discount": coupon_discount()})


def add_is_promo_flag(df: DataFrame) -> DataFrame:
    """``is_promo``: 1 if any of the three discounts is positive, else 0."""
    kinds = (F.col("SMP_discount"), F.col("MP_discount"), F.col("CPN_discount"))
    return df.withColumns({"is_promo": any_discount(*kinds)})


def add_discount_columns(df: DataFrame) -> DataFrame:
    """All four discount columns in one projection."""
    amounts = {
        "SMP_discount": manufacturer_discount(),
        "MP_discount": multipack_discount(),
        "CPN_discount": coupon_discount(),
    }
    return df.withColumns({**amounts, "is_promo": any_discount(*amounts.values())})
