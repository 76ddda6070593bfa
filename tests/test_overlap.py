from __future__ import annotations

import random
from dataclasses import replace
from datetime import date, timedelta

import pytest

from promolens.operators.overlap import add_overlap_flags, detect_overlaps
from tests.helpers import chain, promos, span


def test_chain_leaves_only_the_outer_windows(spark, settings):
    rows = {r.PromotionName: r for r in detect_overlaps(chain(spark, settings), settings).collect()}
    assert [(rows[p].has_before_window, rows[p].has_after_window) for p in ("P1", "P2", "P3", "P4")] == [
        (True, False), (False, False), (False, False), (False, True),
    ]
    assert (rows["P1"].before_window_start, rows["P1"].before_window_end) == (date(2025, 1, 1), date(2025, 7, 1))
    assert (rows["P4"].after_window_start, rows["P4"].after_window_end) == (date(2026, 9, 30), date(2026, 12, 1))
    assert rows["P4"].after_candidate_end == date(2026, 12, 29)
    assert rows["P2"].before_window_start is None and rows["P2"].after_window_end is None


def test_single_promo_by_mode(spark, settings):
    df = promos(spark, [("O", "P", "B", *span(date(2025, 6, 1), 30))], settings)
    zero = detect_overlaps(df, settings).first()
    assert (zero.before_overlap, zero.after_overlap, zero.has_before_window, zero.has_after_window) == (0, 0, True, True)
    null = detect_overlaps(df, replace(settings, unmatched="null")).first()
    assert (null.before_overlap, null.after_overlap, null.has_before_window) == (None, None, None)
    assert null.before_window_start is None


def test_settings_reject_unknown_mode(settings):
    with pytest.raises(ValueError):
        replace(settings, unmatched="maybe")


def test_every_input_column_is_kept(spark, settings):
    df = chain(spark, settings)
    assert detect_overlaps(df, settings).columns[: len(df.columns)] == df.columns


def test_rows_that_cannot_be_compared(spark, settings):
    day = span(date(2025, 6, 1), 30)
    near = span(date(2025, 5, 20), 10)
    df = promos(
        spark,
        [("O", None, "B", *near), ("O", "P", "B", *day), (None, "Q", "B", *near), (None, "R", "B", *day),
         ("O", "S", "B", 20251399, 20251399)],
        settings,
    )
    assert {r.PromotionName: r.before_overlap for r in add_overlap_flags(df).collect()} == {
        None: 0, "P": 0, "Q": 0, "R": 0, "S": 0,
    }
    nulls = {r.PromotionName: r.before_overlap for r in add_overlap_flags(df, "null").collect()}
    assert nulls == {None: None, "P": None, "Q": None, "R": None, "S": None}


def brute_force(rows, unmatched):
    """Each promotion against every other of its outlet and brand."""
    found = {}
    for m in rows:
        others = [
            o for o in rows
            if o.OutletIdentifier == m.OutletIdentifier
            and o.ReportingBrandName == m.ReportingBrandName
            and o.PromotionName != m.PromotionName
        ]
        hits = [
            max((int(o.PromoTrueStartDate_dt <= last and o.PromoTrueEndDate_dt >= first) for o in others), default=None)
            for first, last in (
                (m.before_candidate_start, m.before_candidate_end),
                (m.after_candidate_start, m.after_candidate_end),
            )
        ]
        if unmatched == "zero":
            hits = [h or 0 for h in hits]
        found[m.OutletIdentifier, m.ReportingBrandName, m.PromotionName] = tuple(hits)
    return found


@pytest.mark.parametrize("unmatched", ["zero", "null"])
@pytest.mark.parametrize("seed", range(3))
def test_equals_pairwise_comparison(spark, settings, seed, unmatched):
    """Random promotions, a third of them at one outlet and brand, many with equal dates."""
    rng = random.Random(seed)
    rows = []
    for i in range(240):
        place = ("hot", "B0") if i % 3 == 0 else (f"O{rng.randrange(40)}", f"B{rng.randrange(3)}")
        start = date(2025, 1, 1) + timedelta(days=rng.randrange(0, 700, rng.choice([1, 7, 30])))
        rows.append((place[0], f"P{i}", place[1], *span(start, rng.choice([1, 3, 7, 14, 30, 90]))))
    df = promos(spark, rows, settings)
    got = {
        (r.OutletIdentifier, r.ReportingBrandName, r.PromotionName): (r.before_overlap, r.after_overlap)
        for r in add_overlap_flags(df, unmatched).collect()
    }
    assert got == brute_force(df.collect(), unmatched)
