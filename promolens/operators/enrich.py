"""Joins that bring dimensions to the scan lines and promotions to the loyalty lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.operators.sizes import broadcast_if_small
from promolens.operators.survivors import one_per_key

SALE_KEYS = ("ProductKey", "OutletKey", "DateKey")


def enrich_scan(
    scan: DataFrame,
    product: DataFrame,
    outlet: DataFrame | None = None,
    date: DataFrame | None = None,
    broadcast_rows: int = 0,
) -> DataFrame:
    """Scan lines of the analysed products with the columns of the dimensions given.

    Products are matched inner, which limits the lines to the category; outlets and dates
    left. Leave out a dimension whose columns are not used: a left join stays in the plan
    even if nothing is read from it. With ``broadcast_rows``, each dimension is counted and
    broadcast if it has no more rows, which spares the scan lines a shuffle.
    """
    df = scan.join(broadcast_if_small(product, broadcast_rows), "ProductKey")
    if outlet is not None:
        df = df.join(broadcast_if_small(outlet, broadcast_rows), "OutletKey", "left")
    if date is not None:
        df = df.join(broadcast_if_small(date, broadcast_rows), "DateKey", "left")
    return df


def assert_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Raise if a key occurs twice. Starts a job."""
    repeated = df.groupBy(*keys).count().filter("count > 1").first()
    if repeated is not None:
        raise ValueError(f"{what} is not unique on {list(keys)}: {repeated.asDict()}")
    return df


def match_references(
    df: DataFrame,
    outlet_reference: DataFrame,
    outlet_state: DataFrame,
    product_reference: DataFrame,
    product_variant: DataFrame,
    check_unique: bool = True,
    broadcast_rows: int = 0,
    survivors: bool = False,
) -> DataFrame:
    """Add what the secondary outlet and product tables say, as ``Ref_`` columns.

    Each table is followed by key: outlet key, identifier, state; product key, brand code,
    variant. A key held twice would multiply scan lines, so that is checked first (a job on
    the four small tables) unless the caller knows better. With ``survivors`` one row of each key goes on instead
    (``survivors.one_per_key``; ``survivors.key_conflicts`` names the keys that had others). With ``broadcast_rows`` the two joined references are
    counted and broadcast if small, so that the lines need no shuffle.
    """
    if survivors:
        outlet_reference, outlet_state = one_per_key(outlet_reference, ["OutletKey"]), one_per_key(outlet_state, ["OutletIdentifier"])
        product_reference, product_variant = one_per_key(product_reference, ["ProductKey"]), one_per_key(product_variant, ["ExternalBrandCode"])
    elif check_unique:
        assert_unique(outlet_reference, ["OutletKey"], "outlet reference")
        assert_unique(outlet_state, ["OutletIdentifier"], "outlet state")
        assert_unique(product_reference, ["ProductKey"], "product reference")
        assert_unique(product_variant, ["ExternalBrandCode"], "product variant")
    outlets = outlet_reference.join(outlet_state, "OutletIdentifier", "left").select(
        "OutletKey",
        F.col("OutletIdentifier").alias("Ref_OutletIdentifier"),
        F.col("State").alias("Ref_State"),
    )
    products = product_reference.join(product_variant, "ExternalBrandCode", "left").select(
        "ProductKey",
        F.col("ReportingBrandName").alias("Ref_ReportingBrandName"),
        F.col("ExternalBrandCode").alias("Ref_ExternalBrandCode"),
        F.col("BrandVariant").alias("Ref_BrandVariant"),
    )
    outlets, products = (broadcast_if_small(side, broadcast_rows) for side in (outlets, products))
    return df.join(outlets, "OutletKey", "left").join(products, "ProductKey", "left")


def join_loyalty_promo(loyalty: DataFrame, promo: DataFrame) -> DataFrame:
    """Loyalty lines with the promotion rates of their product, outlet and day.

    Outlet and brand names are kept from the promotion, whose day is ``Promo_DateKey``.
    """
    rates = promo.withColumn("Promo_DateKey", F.col("DateKey"))
    overlap = [c for c in loyalty.columns if c in rates.columns and c not in SALE_KEYS]
    return loyalty.drop(*overlap).join(rates, list(SALE_KEYS))


def promos_with_sales(promo: DataFrame, loyalty: DataFrame) -> DataFrame:
    """Promotion rates for which a loyalty line of the same product, outlet and day exists.

    Enough where only promotion columns are read on, as for promotion spans: a semi join
    never multiplies rows. The sale keys are made distinct before their shuffle, so that a
    key most lines share travels as one row per task; the join reuses that shuffle.
    """
    sold = loyalty.select(*SALE_KEYS).distinct()
    return promo.join(sold, list(SALE_KEYS), "left_semi")
