"""The twelve input views: one filter and one projection each, both left to the file scan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.config import Settings
from promolens.schemas import TABLES
from promolens.sources.catalog import Catalog


@dataclass(frozen=True)
class View:
    """``columns`` of ``table`` where ``condition`` holds; ``None`` leaves that part out."""

    table: str
    columns: tuple[str, ...] | None = None
    condition: Callable[[Settings], Column] | None = None
    unique_rows: bool = False


def _all_but(table: str, *dropped: str) -> tuple[str, ...]:
    return tuple(name for name in TABLES[table].fieldNames() if name not in dropped)


def _active(s: Settings) -> Column:
    return F.col("ActiveFlag") == s.active_flag


def _own_system(s: Settings) -> Column:
    return F.col("SourceSystem") == s.source_system


def _reference_system(s: Settings) -> Column:
    return F.col("SourceSystem") == s.reference_system


def _recent(s: Settings) -> Column:
    return F.col("DateKey") >= s.date_filter


VIEWS: dict[str, View] = {
    "scan": View("scan", _all_but("scan"), _recent),
    "outlet": View(
        "outlet",
        _all_but("outlet", "ActiveFlag", "SourceSystem"),
        lambda s: _active(s) & _own_system(s),
    ),
    "product": View(
        "product",
        _all_but("product", "SourceSystem"),
        lambda s: (F.col("Category") == s.category) & _active(s) & _own_system(s),
    ),
    "date": View("date", _all_but("date")),
    "outlet_reference": View(
        "outlet_reference",
        ("OutletKey", "OutletIdentifier"),
        lambda s: _reference_system(s) & _active(s),
        unique_rows=True,
    ),
    "outlet_state": View(
        "outlet_reference", ("OutletIdentifier", "State"), _reference_system, unique_rows=True
    ),
    "product_reference": View(
        "product_reference",
        ("ProductKey", "ReportingBrandName", "ExternalBrandCode"),
        lambda s: _reference_system(s) & _active(s),
        unique_rows=True,
    ),
    "product_variant": View(
        "product_reference", ("ExternalBrandCode", "BrandVariant"), _reference_system,
        unique_rows=True,
    ),
    "promo_hierarchy": View("promo_hierarchy"),
    "promo_master": View(
        "promo_master",
        _all_but("promo_master"),
        lambda s: _active(s) & F.col("PromotionStatus").isin(*s.promo_statuses),
    ),
    "loyalty_scan": View("loyalty_scan"),
    "single_promo": View("single_promo", _all_but("single_promo"), _recent),
}


def load(catalog: Catalog, name: str, settings: Settings) -> DataFrame:
    view = VIEWS[name]
    df = catalog.table(view.table)
    if view.condition is not None:
        df = df.filter(view.condition(settings))
    if view.columns is not None:
        df = df.select(*view.columns)
    return df.distinct() if view.unique_rows else df


def load_all(catalog: Catalog, settings: Settings) -> dict[str, DataFrame]:
    return {name: load(catalog, name, settings) for name in VIEWS}


def load_scan_table(catalog: Catalog, settings: Settings) -> DataFrame:
    """Scan lines from the first date key on."""
    return load(catalog, "scan", settings)


def load_outlet_table(catalog: Catalog, settings: Settings) -> DataFrame:
    """Active outlets of the own source system."""
    return load(catalog, "outlet", settings)


def load_product_table(catalog: Catalog, settings: Settings) -> DataFrame:
    """Active products of the analysed category and own source system."""
    return load(catalog, "product", settings)


def load_date_table(catalog: Catalog, settings: Settings) -> DataFrame:
    """Calendar with week bounds."""
    return load(catalog, "date", settings)


def load_outlet_reference_table(catalog: Catalog, settings: Settings) -> DataFrame:
    """Outlet key to outlet identifier, active rows of the reference system."""
    return load(catalog, "outlet_reference", settings)


def load_outlet_state_table(catalog: Catalog, settings: Settings) -> DataFrame:
    """Outlet identifier to state, all rows of the reference system."""
    return load(catalog, "outlet_state", settings)


def load_product_reference_table(catalog: Catalog, settings: Settings) -> DataFrame:
    """Product key to reporting brand and external brand code, active rows."""
    return load(catalog, "product_reference", settings)


def load_product_variant_table(catalog: Catalog, settings: Settings) -> DataFrame:
    """External brand code to brand variant, all rows of the reference system."""
    return load(catalog, "product_variant", settings)


def load_promo_hierarchy(catalog: Catalog, settings: Settings) -> DataFrame:
    """Promotion assignments by outlet and day, unfiltered."""
    return load(catalog, "promo_hierarchy", settings)


def load_promo_master(catalog: Catalog, settings: Settings) -> DataFrame:
    """Active promotions that are committed or closed."""
    return load(catalog, "promo_master", settings)


def load_loyalty_scan(catalog: Catalog, settings: Settings) -> DataFrame:
    """Loyalty transactions an earlier run has derived."""
    return load(catalog, "loyalty_scan", settings)


def load_single_promo(catalog: Catalog, settings: Settings) -> DataFrame:
    """Promotion rates by outlet, product and day, from the first date key on."""
    return load(catalog, "single_promo", settings)
