"""The logical tables derived from the order-and-line-item test tables.

Everything grows with those tables: scan lines are line items, outlets are suppliers,
products are parts, and a promotion is a half-year in which a discounted line was sold.
"""

from __future__ import annotations

from datetime import date
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from promolens.config import Settings
from promolens.operators.discounts import add_discount_columns
from promolens.operators.enrich import enrich_scan
from promolens.operators.loyalty import process_loyalty_data
from promolens.sources.catalog import Catalog
from promolens.sources.loaders import load

SETTINGS = Settings(
    source_system="POS",
    reference_system="POS",
    category="CORE",
    date_filter=19970101,
    data_start=date(1997, 1, 1),
    as_of=date(2001, 6, 30),
    brand_rules=(),
)

# Rules for showing brand standardisation; the stages that compare brands use none.
BRAND_RULES = (("Brand#1", "red widget", "Brand#1 Red"), ("Brand#1", "small ring", "Brand#1 Small"))


def _key(day: str) -> str:
    return f"year({day}) * 10000 + month({day}) * 100 + day({day})"


# The amounts have two decimals at most, so these casts are exact.
PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"
DISCOUNT = "CAST(l_discount AS DECIMAL(4,2))"
TAX = "CAST(l_tax AS DECIMAL(4,2))"


def _amount(value: str, name: str) -> str:
    return f"CAST({value} AS DECIMAL(18,4)) AS {name}"


SCAN = (
    "l_suppkey AS OutletKey",
    "l_partkey AS ProductKey",
    f"{_key('l_shipdate')} AS DateKey",
    "try_divide(l_extendedprice, l_quantity) AS MetricPrice",
    "CAST(l_quantity AS DECIMAL(18,2)) AS MetricVolume",
    f"CAST({PRICE} AS DECIMAL(18,2)) AS MetricValue",
    """CASE o_custkey % 10 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN NULL
       ELSE CAST(o_custkey AS STRING) END AS LoyaltyNumber""",
    "CAST(l_returnflag = 'R' AS INT) AS PromotionFlag",
    "CASE WHEN l_linestatus <> 'F' THEN o_orderpriority END AS AccountPromotionName",
    "CAST(l_orderkey AS STRING) AS TransactionID",
    _amount(f"CASE WHEN l_linenumber <= 2 THEN {PRICE} * {DISCOUNT} ELSE 0 END", "ManufacturerDiscountValue"),
    _amount(f"CASE l_linenumber % 3 WHEN 1 THEN 0 WHEN 2 THEN {TAX} END", "ManufacturerMultipackAmount"),
    _amount(TAX, "OutletMultipackDiscountAmount"),
    _amount(f"{PRICE} * {TAX}", "OutletMultipackValue"),
    _amount(f"{PRICE} * {DISCOUNT}", "ManufacturerMultipackValue"),
    _amount(f"CASE WHEN l_returnflag = 'R' THEN {PRICE} * {TAX} ELSE 0 END", "CouponDiscountValue"),
)

ACTIVE_OUTLET = "s_suppkey % 10 <> 8"
OUTLET = (
    "s_suppkey AS OutletKey",
    "lpad(CAST(s_suppkey AS STRING), 6, '0') AS OutletIdentifier",
    "n_name AS State",
    "CASE WHEN s_suppkey % 10 <> 9 THEN r_name END AS SubmitterName",
    "s_nationkey AS ChainId",
    "n_name AS ChainName",
    f"CASE WHEN {ACTIVE_OUTLET} THEN 'A' ELSE 'I' END AS ActiveFlag",
    "'POS' AS SourceSystem",
)

PRODUCT = (
    "p_partkey AS ProductKey",
    "p_type AS Manufacturer",
    "CAST(p_size AS STRING) AS PackSize",
    "p_name AS Brand",
    "concat(p_brand, '-', p_type) AS BrandVariant",
    "'PLAIN' AS Flavour",
    "'GENERAL' AS ProductGroup",
    "'EACH' AS UnitOfMeasure",
    "1D AS ServingUnitFactor",
    "1D AS PurchaseUnitFactor",
    "CASE WHEN p_type <> 'ECONOMY' THEN 'CORE' ELSE 'OTHER' END AS Category",
    "'BRAND' AS TarLevelName",
    "'N' AS IscompanyFlag",
    "'A' AS ActiveFlag",
    "'MAIN' AS EVPSegmentName",
    "p_brand AS ReportingBrandName",
    "'POS' AS SourceSystem",
)

RATE = (
    "l_partkey AS ProductKey",
    "l_suppkey AS OutletKey",
    f"{_key('l_shipdate')} AS DateKey",
    f"{_key('l_shipdate')} AS PromotionRateStartDateKey",
    f"{_key('date_add(l_shipdate, 7 * l_linenumber)')} AS PromotionRateEndDateKey",
    f"{DISCOUNT} AS DiscountLevel",
    "year(l_shipdate) AS year",
    "CASE WHEN month(l_shipdate) <= 6 THEN 1 ELSE 2 END AS half",
)

# Attributes of the promotion of a half-year.
PROMOTION = (
    "concat('PROMO-', year, 'H', half) AS PromotionName",
    "'Save now' AS PromotionSlogan",
    "'PRICE' AS PromotionType",
    "CASE WHEN (year * 10 + half) % 2 = 0 THEN 'multipack' ELSE 'buydown' END AS PromotionCategory",
    "'standard' AS PromotionSubCategory",
    "year * 10000 + CASE half WHEN 1 THEN 101 ELSE 701 END AS PromotionStartDateKey",
    "year * 10000 + CASE half WHEN 1 THEN 630 ELSE 1231 END AS PromotionEndDateKey",
    "CASE WHEN year = 2001 AND half = 2 THEN 'I' ELSE 'A' END AS ActiveFlag",
    "CASE year % 3 WHEN 0 THEN 'Committed' WHEN 1 THEN 'Closed' ELSE 'Draft' END AS PromotionStatus",
    "'CORE' AS TargetProductCategory",
    "'ALL' AS TargetGeography",
    "'ALL' AS TargetSegmentation",
)
LEAST_DISCOUNT = "CAST(0.08 AS DECIMAL(4,2))"

# Every row twice active and once inactive.
COPIES = ("'POS' AS SourceSystem", "explode(array('A', 'A', 'I')) AS ActiveFlag")


def sample_catalog(spark: SparkSession, folder: str) -> Catalog:
    @cache
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    def scan(_: SparkSession) -> DataFrame:
        orders = read("orders").withColumnRenamed("o_orderkey", "l_orderkey")
        return read("lineitem").join(orders, "l_orderkey").selectExpr(*SCAN)

    def outlet(_: SparkSession) -> DataFrame:
        regions = read("region").withColumnRenamed("r_regionkey", "n_regionkey")
        nations = read("nation").join(regions, "n_regionkey").withColumnRenamed("n_nationkey", "s_nationkey")
        return read("supplier").join(nations, "s_nationkey").selectExpr(*OUTLET)

    def product(_: SparkSession) -> DataFrame:
        return read("part").selectExpr(*PRODUCT)

    def calendar(_: SparkSession) -> DataFrame:
        days = read("lineitem").selectExpr("CAST(l_shipdate AS DATE) AS day").distinct()
        return days.selectExpr(
            f"{_key('day')} AS DateKey",
            "trunc(day, 'week') AS WeekStartDate",
            "date_add(trunc(day, 'week'), 6) AS WeekEndDate",
            "year(day) AS CalendarYearNumber",
            "year(day) * 100 + month(day) AS CalendarYearMonthNumber",
        )

    def outlet_reference(_: SparkSession) -> DataFrame:
        return outlet(spark).selectExpr("OutletKey", "OutletIdentifier", "State", *COPIES)

    def product_reference(_: SparkSession) -> DataFrame:
        return read("part").selectExpr(
            "p_partkey AS ProductKey",
            "p_brand AS ReportingBrandName",
            "concat('X', p_brand) AS ExternalBrandCode",
            "p_brand AS BrandVariant",
            *COPIES,
        )

    @cache
    def rates() -> DataFrame:
        """Well discounted lines of active outlets and the category's products."""
        lines = read("lineitem").filter(f"{DISCOUNT} >= {LEAST_DISCOUNT}").selectExpr(*RATE)
        outlets = read("supplier").filter(ACTIVE_OUTLET).selectExpr(*OUTLET[:2])
        products = product(spark).filter("Category = 'CORE'")
        variants = products.selectExpr("ProductKey", "BrandVariant AS Promo_BrandVariant", "ReportingBrandName")
        return lines.join(variants, "ProductKey").join(outlets, "OutletKey")

    def single_promo(_: SparkSession) -> DataFrame:
        return rates().selectExpr("*", *PROMOTION)

    def promo_master(_: SparkSession) -> DataFrame:
        halves = rates().select("year", "half").distinct()
        return halves.selectExpr(f"{LEAST_DISCOUNT} AS DiscountLevel", *PROMOTION)

    def promo_hierarchy(_: SparkSession) -> DataFrame:
        number = "CAST(year * 10 + half AS BIGINT) AS PromotionKey"
        assigned = rates().selectExpr("DateKey", "OutletKey", number).distinct()
        return assigned.selectExpr(
            "*",
            "CASE WHEN PromotionKey % 2 = 0 THEN 'multipack' ELSE 'buydown' END AS PromotionCategory",
            "'standard' AS PromotionSubCategory",
            f"{LEAST_DISCOUNT} AS DiscountLevel",
        )

    def loyalty_scan(_: SparkSession) -> DataFrame:
        lines = enrich_scan(
            add_discount_columns(load(catalog, "scan", SETTINGS)),
            load(catalog, "product", SETTINGS),
            load(catalog, "outlet", SETTINGS),
        )
        return process_loyalty_data(lines, SETTINGS.brand_rules)[1]

    catalog = Catalog(
        spark,
        {
            "scan": scan,
            "outlet": outlet,
            "product": product,
            "date": calendar,
            "outlet_reference": outlet_reference,
            "product_reference": product_reference,
            "promo_hierarchy": promo_hierarchy,
            "promo_master": promo_master,
            "loyalty_scan": loyalty_scan,
            "single_promo": single_promo,
        },
    )
    return catalog
