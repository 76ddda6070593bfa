"""Column names shared between stages and the expected schema of each input table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

# Period labels and column names.
BEFORE, DURING, AFTER = "before_promo", "during_promo", "after_promo"
PERIODS = (BEFORE, DURING, AFTER)

OUTLET, BRAND, PROMO = "OutletIdentifier", "ReportingBrandName", "PromotionName"
START, END = "PromoTrueStartDate_dt", "PromoTrueEndDate_dt"

PLACE_KEYS = (OUTLET, BRAND)
PROMO_KEYS = (OUTLET, BRAND, PROMO, START, END)
TAGGED_COLUMNS = (*PROMO_KEYS, "LoyaltyCode", "MetricVolume", "MetricValue", "period")
METRICS = ("total_volume", "total_value", "total_loyalty_customers")

_s, _i, _l, _d, _date = StringType(), IntegerType(), LongType(), DoubleType(), DateType()
_amount, _discount, _level = DecimalType(18, 2), DecimalType(18, 4), DecimalType(4, 2)


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# The columns of each table.
TABLES: dict[str, StructType] = {
    "scan": _schema(
        OutletKey=_l, ProductKey=_l, DateKey=_i, MetricPrice=_d, MetricVolume=_amount,
        MetricValue=_amount, LoyaltyNumber=_s, PromotionFlag=_i, AccountPromotionName=_s,
        TransactionID=_s, ManufacturerDiscountValue=_discount,
        ManufacturerMultipackAmount=_discount, OutletMultipackDiscountAmount=_discount,
        OutletMultipackValue=_discount, ManufacturerMultipackValue=_discount,
        CouponDiscountValue=_discount,
    ),
    "outlet": _schema(
        OutletKey=_l, OutletIdentifier=_s, State=_s, SubmitterName=_s, ChainId=_i,
        ChainName=_s, ActiveFlag=_s, SourceSystem=_s,
    ),
    "product": _schema(
        ProductKey=_l, Manufacturer=_s, PackSize=_s, Brand=_s, BrandVariant=_s, Flavour=_s,
        ProductGroup=_s, UnitOfMeasure=_s, ServingUnitFactor=_d, PurchaseUnitFactor=_d,
        Category=_s, TarLevelName=_s, IscompanyFlag=_s, ActiveFlag=_s, EVPSegmentName=_s,
        ReportingBrandName=_s, SourceSystem=_s,
    ),
    "date": _schema(
        DateKey=_i, WeekStartDate=_date, WeekEndDate=_date, CalendarYearNumber=_i,
        CalendarYearMonthNumber=_i,
    ),
    "outlet_reference": _schema(
        OutletKey=_l, OutletIdentifier=_s, State=_s, SourceSystem=_s, ActiveFlag=_s,
    ),
    "product_reference": _schema(
        ProductKey=_l, ReportingBrandName=_s, ExternalBrandCode=_s, BrandVariant=_s,
        SourceSystem=_s, ActiveFlag=_s,
    ),
    "promo_hierarchy": _schema(
        DateKey=_i, OutletKey=_l, PromotionKey=_l, PromotionCategory=_s,
        PromotionSubCategory=_s, DiscountLevel=_level,
    ),
    "promo_master": _schema(
        PromotionName=_s, PromotionSlogan=_s, PromotionType=_s, PromotionCategory=_s,
        PromotionSubCategory=_s, PromotionStartDateKey=_i, PromotionEndDateKey=_i,
        DiscountLevel=_level, ActiveFlag=_s, PromotionStatus=_s, TargetProductCategory=_s,
        TargetGeography=_s, TargetSegmentation=_s,
    ),
    "single_promo": _schema(
        ProductKey=_l, OutletKey=_l, DateKey=_i, OutletIdentifier=_s, PromotionName=_s,
        PromotionSlogan=_s, PromotionType=_s, PromotionCategory=_s, PromotionSubCategory=_s,
        PromotionStartDateKey=_i, PromotionEndDateKey=_i, PromotionRateStartDateKey=_i,
        PromotionRateEndDateKey=_i, DiscountLevel=_level, ActiveFlag=_s,
        Promo_BrandVariant=_s, ReportingBrandName=_s, PromotionStatus=_s,
        TargetProductCategory=_s, TargetGeography=_s, TargetSegmentation=_s,
    ),
    # Pre-built by an earlier run: only the columns later stages read are required.
    "loyalty_scan": _schema(
        OutletIdentifier=_s, ReportingBrandName=_s, DateKey=_i, LoyaltyCode=_s,
        MetricVolume=_amount, MetricValue=_amount,
    ),
}


def missing_columns(df: DataFrame, expected: StructType) -> list[str]:
    return [name for name in expected.fieldNames() if name not in df.columns]


def conform(df: DataFrame, expected: StructType, table: str) -> DataFrame:
    """Require the expected columns and cast those of another kind of type.

    Any numeric type is accepted where a number is expected: a cast there would only get
    between the file scan and its pushed filters. Extra columns pass through.
    """
    missing = missing_columns(df, expected)
    if missing:
        raise ValueError(f"table {table!r} lacks columns {missing}")
    found = {field.name: field.dataType for field in df.schema}
    casts = {
        want.name: F.col(want.name).cast(want.dataType)
        for want in expected
        if not _same_kind(found[want.name], want.dataType)
    }
    return df.withColumns(casts) if casts else df


def _same_kind(found: DataType, want: DataType) -> bool:
    if isinstance(want, NumericType):
        return isinstance(found, NumericType)
    return isinstance(found, type(want))
