"""Label loyalty transactions with the promotions and periods they fall in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.config import Settings
from promolens.functions.dates import (
    date_from_key,
    key_from_date,
    month_of_date,
    month_of_key,
)
from promolens.operators.sizes import broadcast_if_small
from promolens.schemas import (
    AFTER,
    BEFORE,
    DURING,
    END,
    PERIODS,
    PLACE_KEYS,
    PROMO_KEYS,
    START,
    TAGGED_COLUMNS,
)

# The columns that bound each period.
PERIOD_BOUNDS = {
    BEFORE: ("before_window_start", "before_window_end"),
    DURING: (START, END),
    AFTER: ("after_window_start", "after_window_end"),
}

# The same with what must hold for the period to exist.
PERIOD_SPANS = {
    BEFORE: ("has_before_window", *PERIOD_BOUNDS[BEFORE]),
    DURING: ("true", *PERIOD_BOUNDS[DURING]),
    AFTER: ("has_after_window", *PERIOD_BOUNDS[AFTER]),
}


def prepare_loyalty_dates(loyalty: DataFrame, date_col: str = "DateKey") -> DataFrame:
    """``DateKey_dt``: the transaction day as a date, null for a bad key."""
    return loyalty.withColumns({"DateKey_dt": date_from_key(F.col(date_col))})


def get_during_windows(windows: DataFrame) -> DataFrame:
    """Every promotion has a during period."""
    return windows.select(*PROMO_KEYS)


def get_before_windows(windows: DataFrame) -> DataFrame:
    """Promotions whose before window was accepted."""
    return windows.filter("has_before_window").select(*PROMO_KEYS, *PERIOD_BOUNDS[BEFORE])


def get_after_windows(windows: DataFrame) -> DataFrame:
    """Promotions whose after window was accepted."""
    return windows.filter("has_after_window").select(*PROMO_KEYS, *PERIOD_BOUNDS[AFTER])


def period_spans(windows: DataFrame, periods: Sequence[str] = PERIODS) -> DataFrame:
    """One row per promotion and period that has dates: ``period``, ``span_start``, ``span_end``."""
    spans = [
        f"'{period}', CASE WHEN {accepted} THEN {first} END, CASE WHEN {accepted} THEN {last} END"
        for period, (accepted, first, last) in PERIOD_SPANS.items()
        if period in periods
    ]
    stacked = F.expr(f"stack({len(spans)}, {', '.join(spans)}) AS (period, span_start, span_end)")
    # Also drops spans with an unknown end or none of whose days exist.
    return windows.select(*PROMO_KEYS, stacked).filter("span_start <= span_end")


# Keys of days are ordered as the days are. The date is only made of those that match, to
# leave out a key that names no day.
INSIDE = """
    sale_key BETWEEN first_key AND last_key
    AND try_to_date(CAST(sale_key AS STRING), 'yyyyMMdd') IS NOT NULL
"""


def by_month(
    loyalty: DataFrame, spans: DataFrame, settings: Settings, date_col: str
) -> tuple[DataFrame, DataFrame]:
    """Both sides of the interval join, with date keys and a ``month`` to join on.

    A transaction is in one month; a span is repeated for each month it touches. Days
    outside the analysed range share its outermost months, so even a promotion without a
    real end date is repeated no more often than that range has months. The dates of the
    spans are turned into keys, not the other way round: there are far fewer spans.
    """
    return sales_by_month(loyalty, settings, date_col), with_months(with_date_keys(spans), settings)


def sales_by_month(loyalty: DataFrame, settings: Settings, date_col: str) -> DataFrame:
    """Transactions with their ``month``, the date column as ``sale_key``."""
    month = month_of_key(F.col(date_col), key_from_date(settings.first_day), key_from_date(settings.today))
    return loyalty.withColumns({"month": month}).withColumnRenamed(date_col, "sale_key")


def with_date_keys(spans: DataFrame) -> DataFrame:
    return spans.withColumns({"first_key": key_from_date(F.col("span_start")), "last_key": key_from_date(F.col("span_end"))})


def with_months(spans: DataFrame, settings: Settings) -> DataFrame:
    """Spans repeated for each ``month`` they touch."""
    edges = (month_of_date(F.col(edge), settings.first_day, settings.today) for edge in ("span_start", "span_end"))
    return spans.select("*", F.explode(F.sequence(*edges)).alias("month"))


def tag_transactions(
    loyalty: DataFrame,
    windows: DataFrame,
    settings: Settings,
    date_col: str = "DateKey",
    periods: Sequence[str] = PERIODS,
    broadcast_rows: int = 0,
) -> DataFrame:
    """Transactions of every promotion period they fall in, one row per match.

    One interval join serves all periods, so the transactions are read once. Its equality
    keys are outlet, brand and month, so a transaction does not meet promotions of another
    season, and an outlet and brand with very many transactions is spread over its months;
    what is still too large for one task, adaptive execution splits.

    With ``broadcast_rows`` the spans are counted first and broadcast if there are no more
    than that many. Ask for it only where the windows are a stored table.
    """
    sales = loyalty.select(*PLACE_KEYS, date_col, "LoyaltyCode", "MetricVolume", "MetricValue")
    sales, spans = by_month(sales, period_spans(windows, periods), settings, date_col)
    # The keys of a span's days stand for them, so the dates need not travel, nor the period if there is one only.
    spans = spans.drop("span_start", "span_end", *(["period"] if len(periods) == 1 else []))
    spans = broadcast_if_small(spans, broadcast_rows)
    matched = sales.join(spans, [*PLACE_KEYS, "month"]).filter(INSIDE)
    if len(periods) == 1:
        matched = matched.withColumns({"period": F.lit(periods[0])})
    return matched.select(*TAGGED_COLUMNS)


def tag_during_transactions(loyalty: DataFrame, windows: DataFrame, settings: Settings, **options) -> DataFrame:
    """Transactions inside a promotion."""
    return tag_transactions(loyalty, windows, settings, periods=[DURING], **options)


def tag_before_transactions(loyalty: DataFrame, windows: DataFrame, settings: Settings, **options) -> DataFrame:
    """Transactions inside an accepted before window."""
    return tag_transactions(loyalty, windows, settings, periods=[BEFORE], **options)


def tag_after_transactions(loyalty: DataFrame, windows: DataFrame, settings: Settings, **options) -> DataFrame:
    """Transactions inside an accepted after window."""
    return tag_transactions(loyalty, windows, settings, periods=[AFTER], **options)


def union_all_periods(*tagged: DataFrame) -> DataFrame:
    """All rows of frames tagged apart, columns matched by name."""
    combined = tagged[0].select(*TAGGED_COLUMNS)
    for more in tagged[1:]:
        combined = combined.unionByName(more.select(*TAGGED_COLUMNS))
    return combined
