"""Discount amounts of one scan line by funding type, and whether any of them applies."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def manufacturer_discount() -> Column:
    return F.col("ManufacturerDiscountValue")


def multipack_discount() -> Column:
    """Manufacturer-funded where the manufacturer paid, else outlet-funded, else 0.

    An unknown manufacturer amount satisfies neither branch and gives 0.
    """
    manufacturer = F.col("ManufacturerMultipackAmount")
    outlet = F.col("OutletMultipackDiscountAmount")
    return (
        F.when(manufacturer > 0, F.col("ManufacturerMultipackValue"))
        .when((manufacturer <= 0) & (outlet > 0), F.col("OutletMultipackValue"))
        .otherwise(0)
    )


def coupon_discount() -> Column:
    return F.col("CouponDiscountValue")


def any_discount(*amounts: Column) -> Column:
    """1 if any amount is positive, else 0; an unknown amount counts as none."""
    return F.when(reduce(or_, (amount > 0 for amount in amounts)), 1).otherwise(0)
