"""Run settings. Every date and literal a query depends on is here, so a run can be repeated exactly."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Brand standardisation rules (reporting brand, brand, standardised name).
DEFAULT_BRAND_RULES: tuple[tuple[str, str, str], ...] = (
    ("Brand_X", "Variant_A", "Standardised_Name_A"),
    ("Brand_X", "Variant_B", "Standardised_Name_B"),
)

# Fixed value: where metrics are saved if no table is named.
DEFAULT_METRICS_TABLE = "your_schema.promo_metrics"


@dataclass(frozen=True)
class Settings:
    """What to load and which dates bound the analysis.

    ``as_of`` plays the part of "today"; left ``None`` it is the session's current date.
    ``unmatched`` says what overlap flag a promotion gets that has no other promotion at
    its outlet and brand: ``"zero"`` (no overlap) or ``"null"`` (unknown, so neither
    window is accepted). Dimensions and promotion spans are broadcast if a count finds at
    most ``broadcast_rows`` rows. More than ``max_gap_days`` days without sales fail the checks.
    """

    # The defaults of what is loaded.
    source_system: str = "your_source_system"
    reference_system: str = "your_source"
    active_flag: str = "A"
    category: str = "your_product_category"
    promo_statuses: tuple[str, ...] = ("Committed", "Closed")
    date_filter: int = 20250101
    data_start: date = date(2025, 1, 1)
    as_of: date | None = None
    unmatched: str = "zero"
    brand_rules: tuple[tuple[str, str, str], ...] = DEFAULT_BRAND_RULES
    broadcast_rows: int = 1_000_000
    # The longest run of days without any sale that is no sign of lost data.
    max_gap_days: int = 7

    def __post_init__(self) -> None:
        if self.unmatched not in ("zero", "null"):
            raise ValueError(f"unmatched must be 'zero' or 'null', not {self.unmatched!r}")

    @property
    def today(self) -> Column:
        return F.current_date() if self.as_of is None else F.lit(self.as_of)

    @property
    def first_day(self) -> Column:
        return F.lit(self.data_start)
