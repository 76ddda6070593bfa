"""The stages of one analysis, each a DataFrame built on the ones before it."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.config import Settings
from promolens.operators.discounts import add_discount_columns
from promolens.operators.enrich import enrich_scan, promos_with_sales
from promolens.operators.loyalty import process_loyalty_data, standardise_promo_brands
from promolens.operators.metrics import add_derived_metrics, ledger_of, rollup_by_customer, rollup_of, rollup_with_ledger, widen_rollup
from promolens.operators.overlap import detect_overlaps
from promolens.operators.promo_windows import build_promo_windows
from promolens.operators.tagging import tag_transactions
from promolens.quality.core import measure
from promolens.quality.layers import tagged_totals
from promolens.schemas import BRAND, OUTLET
from promolens.sources.catalog import Catalog
from promolens.sources.loaders import load
from promolens.sources.sink import stage, stage_folder


class Stages:
    """Frames of one analysis. All are lazy, but those that a later stage reads more than
    once are first written to the shared folder and read back (see :meth:`kept`).

    ``promo_input`` says which promotions count: ``"single_promo"`` takes all rates,
    ``"joined"`` only those with a loyalty sale of the same product, outlet and day. The
    first is the default because a promotion nobody with a card bought from still spoils
    the windows of its neighbours. ``loyalty_input`` says whether loyalty lines are derived from
    the scan or read from the ``loyalty_scan`` table an earlier run saved. ``separator`` parts
    chain and card in derived codes.
    """

    def __init__(
        self,
        catalog: Catalog,
        settings: Settings,
        promo_input: str = "single_promo",
        loyalty_input: str = "scan",
        separator: str = "",
    ):
        if promo_input not in ("single_promo", "joined"):
            raise ValueError(f"promo_input must be 'single_promo' or 'joined', not {promo_input!r}")
        if loyalty_input not in ("scan", "loyalty_scan"):
            raise ValueError(f"loyalty_input must be 'scan' or 'loyalty_scan', not {loyalty_input!r}")
        self.loyalty_input = loyalty_input
        self.separator = separator
        self.catalog = catalog
        self.settings = settings
        self.promo_input = promo_input
        self._kept: dict[str, DataFrame] = {}

    @cached_property
    def folder(self) -> str:
        return stage_folder(self.catalog.spark)

    def kept(self, name: str) -> DataFrame:
        """The stage of that name as a stored table, written when first asked for.

        Overlap detection reads the promotions twice and tagging needs to know how large the
        windows are. Without this, the promotion rates would be scanned once per use.
        """
        if name in ("rollup", "ledger") and name not in self._kept:
            accounts = stage(rollup_with_ledger(self.tagged), self.folder, "accounts", by="level")
            self._kept |= {"rollup": rollup_of(accounts), "ledger": ledger_of(accounts)}
        if name not in self._kept:
            self._kept[name] = stage(getattr(self, name), self.folder, name)
        return self._kept[name]

    @cached_property
    def totals(self) -> DataFrame:
        """Totals of the tagged transactions: the sum of the ledger that was stored with their rollup."""
        return measure(self.kept("ledger"), tagged_totals())

    def table(self, name: str) -> DataFrame:
        return load(self.catalog, name, self.settings)

    @cached_property
    def scan(self) -> DataFrame:
        """Scan lines with discount columns."""
        return add_discount_columns(self.table("scan"))

    @cached_property
    def enriched(self) -> DataFrame:
        """Scan lines of the category with product and outlet columns."""
        return enrich_scan(
            self.scan,
            self.table("product"),
            self.table("outlet"),
            broadcast_rows=self.settings.broadcast_rows,
        )

    @cached_property
    def loyalty(self) -> tuple[DataFrame, DataFrame]:
        if self.loyalty_input == "loyalty_scan":
            return (self.table("loyalty_scan"),) * 2
        return process_loyalty_data(self.enriched, self.settings.brand_rules, self.separator)

    @property
    def loyalty_all(self) -> DataFrame:
        return self.loyalty[0]

    @property
    def loyalty_valid(self) -> DataFrame:
        return self.loyalty[1]

    @cached_property
    def rates(self) -> DataFrame:
        """Promotion rates the spans are taken from."""
        promo = self.table("single_promo")
        if self.promo_input == "joined":
            promo = promos_with_sales(promo, self.loyalty_valid)
        if not self.settings.brand_rules:
            return promo
        return standardise_promo_brands(promo, self.table("product"), self.settings.brand_rules, self.settings.broadcast_rows)

    @cached_property
    def promos(self) -> DataFrame:
        return build_promo_windows(self.rates, self.settings)

    @cached_property
    def windows(self) -> DataFrame:
        return detect_overlaps(self.kept("promos"), self.settings)

    @cached_property
    def tagged(self) -> DataFrame:
        return tag_transactions(
            self.loyalty_valid,
            self.kept("windows"),
            self.settings,
            broadcast_rows=self.settings.broadcast_rows,
        )

    @cached_property
    def rollup(self) -> DataFrame:
        """One row per promotion, period and customer.

        The tagged transactions themselves are never stored: whatever is asked about them,
        this smaller set answers.
        """
        return rollup_by_customer(self.tagged)

    @cached_property
    def metrics(self) -> DataFrame:
        return add_derived_metrics(widen_rollup(self.rollup))

    def place(self, outlet_id: str, brand_name: str) -> DataFrame:
        """The windows of one outlet and brand. Every step is per place, so its rates alone are read."""
        rates = self.rates.filter((F.col(OUTLET) == outlet_id) & (F.col(BRAND) == brand_name))
        return detect_overlaps(build_promo_windows(rates, self.settings), self.settings)
