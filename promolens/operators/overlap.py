"""Which candidate windows another promotion of the same outlet and brand runs into.

A before window ends the day before its promotion starts, so another promotion overlaps it
exactly if it starts on an earlier day and ends on or after the window's first day. Of all
promotions that start earlier only the latest end matters; mirrored, of all that end later
only the earliest start matters. Both are running extremes over an ordering, so no two
promotions need to be paired.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.config import Settings
from promolens.schemas import BRAND, END, OUTLET, PROMO, START

SPAN_KEYS = (OUTLET, BRAND, START, END)


def neighbouring_spans(promos: DataFrame) -> DataFrame:
    """Per distinct span of an outlet and brand: ``latest_earlier_end`` and
    ``earliest_later_start`` of the others, and how many dated promotions the place has.

    Promotions with equal dates are folded into one row before anything is sorted. What the
    window sorts is thus limited by the calendar (pairs of days), not by the number of
    promotions, even if one outlet and brand has most of them.
    """
    # Rows without a name or dates are masked rather than filtered out: a filter would move
    # below the aggregation the spans come from and have it computed a second time.
    spans = promos.groupBy(*SPAN_KEYS).agg(F.count(PROMO).alias("promos"))
    counted = (F.col("promos") > 0) & F.col(START).isNotNull() & F.col(END).isNotNull()
    place = Window.partitionBy(OUTLET, BRAND)
    # The second order runs backwards in time: a frame that reaches back to the first row
    # grows as it goes, one that reaches on to the last row would be summed anew per row.
    starts_earlier = place.orderBy(F.unix_date(START)).rangeBetween(Window.unboundedPreceding, -1)
    ends_later = place.orderBy(-F.unix_date(END)).rangeBetween(Window.unboundedPreceding, -1)
    return spans.select(
        *(F.col(key).alias(f"span_{key}") for key in SPAN_KEYS),
        F.max(F.when(counted, F.col(END))).over(starts_earlier).alias("latest_earlier_end"),
        F.min(F.when(counted, F.col(START))).over(ends_later).alias("earliest_later_start"),
        F.sum(F.when(counted, F.col("promos"))).over(place).alias("place_promos"),
    )


def add_overlap_flags(promos: DataFrame, unmatched: str = "zero") -> DataFrame:
    """``before_overlap`` and ``after_overlap``, 1 or 0, with every input column kept.

    A promotion alone at its place, or without a name, place or dates to compare, gets 0, or
    null with ``unmatched="null"``.
    """
    same_span = [F.col(key).eqNullSafe(F.col(f"span_{key}")) for key in SPAN_KEYS]
    comparable = F.lit(True)
    for key in (PROMO, *SPAN_KEYS):
        comparable = comparable & F.col(key).isNotNull()
    if unmatched == "null":
        comparable = comparable & (F.col("place_promos") > 1)

    def flag(overlaps: Column) -> Column:
        known = F.when(comparable, F.coalesce(overlaps, F.lit(False)).cast("int"))
        return F.coalesce(known, F.lit(0)) if unmatched == "zero" else known

    before = F.col("latest_earlier_end") >= F.col("before_candidate_start")
    after = F.col("earliest_later_start") <= F.col("after_candidate_end")
    return promos.join(neighbouring_spans(promos), same_span, "left").select(
        *promos.columns,
        flag(before).alias("before_overlap"),
        flag(after).alias("after_overlap"),
    )


def mark_valid_windows(flagged: DataFrame, settings: Settings) -> DataFrame:
    """Accept a window that has data and no overlap; its dates are null otherwise.

    An after window that reaches past today is cut there.
    """
    accepted = flagged.withColumns(
        {
            f"has_{side}_window": F.col(f"{side}_data_ok") & (F.col(f"{side}_overlap") == 0)
            for side in ("before", "after")
        }
    )
    last_day = F.least(F.col("after_candidate_end"), settings.today)
    return accepted.withColumns(
        {
            "before_window_start": F.when(F.col("has_before_window"), F.col("before_candidate_start")),
            "before_window_end": F.when(F.col("has_before_window"), F.col("before_candidate_end")),
            "after_window_start": F.when(F.col("has_after_window"), F.col("after_candidate_start")),
            "after_window_end": F.when(F.col("has_after_window"), last_day),
        }
    )


def detect_overlaps(promos: DataFrame, settings: Settings) -> DataFrame:
    """One row per promotion with overlap flags and the windows that are accepted."""
    return mark_valid_windows(add_overlap_flags(promos, settings.unmatched), settings)
