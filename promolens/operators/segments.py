"""Tagging by elementary segments: a place's calendar cut at every end of a span, each piece with the promotions that hold in it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promolens.config import Settings
from promolens.functions.dates import month_of_date
from promolens.operators.sizes import is_small
from promolens.operators.tagging import INSIDE, period_spans, sales_by_month, with_date_keys, with_months
from promolens.schemas import END, PERIODS, PLACE_KEYS, PROMO, START, TAGGED_COLUMNS

HOLDER = (PROMO, START, END, "period")


def elementary_segments(windows: DataFrame, periods: Sequence[str] = PERIODS, settings: Settings | None = None) -> DataFrame:
    """The pieces of each place's calendar between two neighbouring ends of its spans: ``span_start``, ``span_end`` and
    ``holders``, the promotions and periods that cover the whole piece. Pieces nobody covers are left out.

    Pieces of a place do not meet, so a day is in one at most, and a place has no more of them than its calendar has days,
    however many promotions it has. The ends of a place are gathered once, each day once, and a span's pieces lie between
    its own two. Spans are shuffled once, by place. With ``settings`` they are cut at the ends of months first and dealt by
    place and ``month``, as ``tagging.by_month`` deals sales.
    """
    spans = period_spans(windows, periods).filter(F.col(PLACE_KEYS[0]).isNotNull() & F.col(PLACE_KEYS[1]).isNotNull())
    keys = [*PLACE_KEYS]
    if settings is not None:
        spans, keys = _cut_at_months(spans, settings), [*keys, "month"]
    calendar = Window.partitionBy(*keys)
    gathered = spans.withColumns({"starts": F.collect_set("span_start").over(calendar), "ends": F.collect_set("span_end").over(calendar)})
    cuts = gathered.withColumns({"cuts": F.expr("array_sort(array_union(starts, transform(ends, d -> date_add(d, 1))))")})
    placed = cuts.withColumns({"a": F.expr("int(array_position(cuts, span_start))"), "b": F.expr("int(array_position(cuts, date_add(span_end, 1)))")})
    pieces = F.arrays_zip(F.expr("slice(cuts, a, b - a)").alias("piece_start"), F.expr("slice(cuts, a + 1, b - a)").alias("next"))
    held = placed.select(*keys, F.struct(*HOLDER).alias("holder"), F.inline(pieces))
    folded = held.groupBy(*keys, "piece_start", "next").agg(F.collect_list("holder").alias("holders"))
    return folded.select(*keys, F.col("piece_start").alias("span_start"), F.date_sub("next", 1).alias("span_end"), "holders")


def _cut_at_months(spans: DataFrame, settings: Settings) -> DataFrame:
    """Spans repeated for each ``month`` they touch, cut to its days; the outermost months reach on without end."""
    repeated = with_months(spans, settings)
    first, last = (month_of_date(day, settings.first_day, settings.today) for day in (settings.first_day, settings.today))
    begin = F.expr("make_date(int((month - 1) div 12), int((month - 1) % 12 + 1), 1)")
    return repeated.withColumns(
        {
            "span_start": F.when(F.col("month") == first, F.col("span_start")).otherwise(F.greatest("span_start", begin)),
            "span_end": F.when(F.col("month") == last, F.col("span_end")).otherwise(F.least("span_end", F.last_day(begin))),
        }
    )


def tag_by_segments(
    loyalty: DataFrame,
    windows: DataFrame,
    settings: Settings,
    date_col: str = "DateKey",
    periods: Sequence[str] = PERIODS,
    broadcast_rows: int = 0,
) -> DataFrame:
    """The rows of ``tagging.tag_transactions``, each transaction matched to one segment and then repeated for its holders.

    In place of every span of its place and month, of which there may be thousands, a transaction meets at most a month's
    days of segments, and the join yields no more rows than there are transactions. Worth it where very many promotions
    of a place run at a time; a promotion's names are then repeated in each segment it covers.

    Segments are made where they are joined: spans are dealt by place and month once, and so are the sales. With
    ``broadcast_rows`` the spans are counted, not the segments, which would be made a second time; of a month's days there
    are 31, so a span is held in no more segments of it. All sales of an outlet, brand and month are met in one task.
    """
    sales = sales_by_month(loyalty.select(*PLACE_KEYS, date_col, "LoyaltyCode", "MetricVolume", "MetricValue"), settings, date_col)
    segments = with_date_keys(elementary_segments(windows, periods, settings))
    if is_small(with_months(period_spans(windows, periods), settings), broadcast_rows):
        segments = F.broadcast(segments)
    matched = sales.join(segments, [*PLACE_KEYS, "month"]).filter(INSIDE)
    return matched.select("*", F.inline("holders")).select(*TAGGED_COLUMNS)
