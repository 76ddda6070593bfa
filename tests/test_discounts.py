from __future__ import annotations

from decimal import Decimal

import pytest

from promolens.operators import discounts

SOURCES = """ManufacturerDiscountValue decimal(18,4), ManufacturerMultipackAmount decimal(18,4),
    OutletMultipackDiscountAmount decimal(18,4), OutletMultipackValue decimal(18,4),
    ManufacturerMultipackValue decimal(18,4), CouponDiscountValue decimal(18,4)"""


def amounts(*values):
    return tuple(None if v is None else Decimal(v) for v in values)


@pytest.mark.parametrize(
    ("manufacturer", "outlet", "expected"),
    [(0, 5, 7), (-1, 5, 7), (3, 5, 9), (0, 0, 0), (None, 5, 0), (3, None, 9), (0, None, 0)],
)
def test_multipack_discount(spark, manufacturer, outlet, expected):
    df = spark.createDataFrame([amounts(0, manufacturer, outlet, 7, 9, 0)], SOURCES)
    assert discounts.add_mp_discount(df).first().MP_discount == expected


@pytest.mark.parametrize(
    ("kinds", "expected"),
    [((None, None, None), 0), ((None, 0, 1), 1), ((0, 0, 0), 0), ((1, None, -1), 1), ((-1, 0, None), 0)],
)
def test_is_promo(spark, kinds, expected):
    df = spark.createDataFrame(
        [amounts(*kinds)], "SMP_discount decimal(9,2), MP_discount decimal(9,2), CPN_discount decimal(9,2)"
    )
    assert discounts.add_is_promo_flag(df).first().is_promo == expected


def test_all_columns_equal_single_steps(spark):
    df = spark.createDataFrame(
        [amounts(1, 0, 5, 7, 9, 0), amounts(0, 3, 5, 7, 9, 0), amounts(0, None, 0, 7, 9, 2), amounts(*[None] * 6)],
        SOURCES,
    )
    stepwise = df
    for step in ("add_smp_discount", "add_mp_discount", "add_cpn_discount", "add_is_promo_flag"):
        stepwise = getattr(discounts, step)(stepwise)
    assert discounts.add_discount_columns(df).collect() == stepwise.collect()
    assert [r.is_promo for r in stepwise.collect()] == [1, 1, 1, 0]
