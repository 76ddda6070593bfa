"""Keeping the rollup by customer up to date: new sales are added, and only places whose past spans changed are tagged anew."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.config import Settings
from promolens.operators.metrics import rollup_by_customer
from promolens.operators.sizes import broadcast_if_small
from promolens.operators.tagging import PERIOD_SPANS, tag_transactions
from promolens.schemas import PLACE_KEYS, PROMO_KEYS

ROLLUP_KEYS = (*PROMO_KEYS, "period", "LoyaltyCode")


def merge_rollups(*rollups: DataFrame) -> DataFrame:
    """The rollup of all the transactions that those given were made of, no transaction in two of them.

    Every column beside the keys is a sum, so rollups add up in any order.
    """
    together = reduce(DataFrame.unionByName, rollups)
    sums = [F.sum(c).alias(c) for c in together.columns if c not in ROLLUP_KEYS]
    merged = together.groupBy(*ROLLUP_KEYS).agg(*sums)
    # A sum of decimals is wider than its input; back to the stored type, so that updates do not widen it further.
    return merged.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in rollups[0].schema))


def changed_places(old_windows: DataFrame, new_windows: DataFrame, upto: date) -> DataFrame:
    """Places where a day up to ``upto`` lies in other promotions or periods than before.

    Spans are compared as far as that day only: one that merely runs on, because its promotion still does or the window
    after it was cut at a former today, tags the same past days. Both sides are counted against each other, so that
    repeated spans must be equally many: first promotions with all their spans, one row each; then the spans of the
    promotions left over, which may still make up for each other.
    """

    def past(windows: DataFrame, sign: int) -> DataFrame:
        spans = {}
        for period, (accepted, first, last) in PERIOD_SPANS.items():
            last = F.least(last, F.lit(upto))
            known = F.expr(accepted) & (F.col(first) <= last)
            spans |= {f"{period}_first": F.when(known, F.col(first)), f"{period}_last": F.when(known, last)}
        kept = windows.select(*PROMO_KEYS, *(span.alias(name) for name, span in spans.items()), F.lit(sign).alias("sign"))
        return kept.filter(" OR ".join(f"{period}_first IS NOT NULL" for period in PERIOD_SPANS))

    both = past(old_windows, -1).unionByName(past(new_windows, 1))
    whole = both.groupBy(*(c for c in both.columns if c != "sign")).agg(F.sum("sign").alias("change")).filter("change <> 0")
    each = ", ".join(f"'{period}', {period}_first, {period}_last" for period in PERIOD_SPANS)
    stacked = F.expr(f"stack({len(PERIOD_SPANS)}, {each}) AS (period, span_start, span_end)")
    spans = whole.select(*PROMO_KEYS, "change", stacked).filter("span_start IS NOT NULL")
    changes = spans.groupBy(*PROMO_KEYS, "period", "span_start", "span_end").agg(F.sum("change").alias("change"))
    return changes.filter("change <> 0").select(*PLACE_KEYS).distinct()


def update_rollup(
    stored: DataFrame,
    old_windows: DataFrame,
    new_windows: DataFrame,
    history: DataFrame,
    arrived: DataFrame,
    settings: Settings,
    upto: date,
    date_col: str = "DateKey",
    broadcast_rows: int = 0,
    changed: DataFrame | None = None,
) -> DataFrame:
    """The rollup of ``history`` and ``arrived`` under ``new_windows``, from the ``stored`` one of ``history`` under
    ``old_windows``.

    No line of ``history`` may be later than ``upto``; lines that arrived may be of any day. Where the past spans are the
    same, stored rows stay and only what arrived is tagged; elsewhere the stored rows are dropped and the place's whole
    history is tagged again. History is read with the changed places as a filter, broadcast if they are few. The
    result replaces the stored table, with the new windows: applied twice to a table already updated, it would count
    what arrived twice. The changed places are read up to three times: give ``changed_places`` of the same arguments as a
    stored table by ``changed``, or they are computed from the windows each time.
    """
    if changed is None:
        changed = changed_places(old_windows, new_windows, upto)
    # Places without a name have no sales that could match.
    changed = broadcast_if_small(changed.dropna(), broadcast_rows)
    keys = list(PLACE_KEYS)
    lines = [*PLACE_KEYS, date_col, "LoyaltyCode", "MetricVolume", "MetricValue"]
    again = history.select(*lines).join(changed, keys, "left_semi").unionByName(arrived.select(*lines))
    tagged = tag_transactions(again, new_windows, settings, date_col, broadcast_rows=broadcast_rows)
    return merge_rollups(stored.join(changed, keys, "left_anti"), rollup_by_customer(tagged))
