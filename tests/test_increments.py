from __future__ import annotations

import random
from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from promolens.operators import increments
from promolens.operators.metrics import rollup_by_customer
from promolens.operators.overlap import detect_overlaps
from promolens.operators.tagging import tag_transactions
from promolens.sources.sink import stage, stage_folder
from tests.conftest import bag
from tests.helpers import key, promos
from tests.test_segments import FIRST, lines, rates


def windows(spark, rows, settings, name, folder):
    return stage(detect_overlaps(promos(spark, rows, settings), settings), folder, name)


def state(spark, settings, rows, upto, folder):
    known = replace(settings, as_of=upto)
    return windows(spark, rows, known, f"windows_{upto}", folder)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("late", [False, True])
def test_increments_equal_one_full_run(spark, settings, seed, late):
    """Two increments, with promotions that start, grow and vanish between runs, and lines that come in late."""
    rng = random.Random(seed)
    folder, all_rates, loyalty = stage_folder(spark), rates(rng), lines(spark, rng)
    loyalty = stage(loyalty.withColumn("come", F.lit(0)), folder, "loyalty")
    days = [FIRST + timedelta(days=150), FIRST + timedelta(days=300), FIRST + timedelta(days=1000)]
    # lines without a readable day have none to be late by
    run = F.when(F.col("DateKey") > key(days[1]), 2).when(F.col("DateKey") > key(days[0]), 1).otherwise(0)
    if late:
        run = F.greatest(run, F.pmod(F.xxhash64("LoyaltyCode"), F.lit(3)))
    loyalty = loyalty.withColumn("come", run.cast("int"))
    known = [
        [r for r in all_rates if r[3] <= key(day) and not (day == days[1] and r[1] in ("P3", "P9"))] for day in days
    ]
    before = state(spark, settings, known[0], days[0], folder)
    kept = stage(rollup_by_customer(tag_transactions(loyalty.filter("come = 0"), before, settings)), folder, "rollup_0")
    for k in (1, 2):
        after = state(spark, settings, known[k], days[k], folder)
        updated = increments.update_rollup(
            kept, before, after, loyalty.filter(F.col("come") < k), loyalty.filter(F.col("come") == k), settings, days[k - 1]
        )
        kept, before = stage(updated, folder, f"rollup_{k}"), after
        full = rollup_by_customer(tag_transactions(loyalty.filter(F.col("come") <= k), after, settings))
        assert bag(kept) == bag(full.select(*kept.columns)) and kept.count() > 50
        assert kept.schema.simpleString() == full.schema.simpleString()


def test_only_changed_pasts_count(spark, settings):
    """A window cut at a former today, a promotion still to come and one that did not change leave their places alone."""
    folder, upto, now = stage_folder(spark), date(2025, 9, 30), date(2025, 12, 31)
    old = [("same", "P", "B", 20250601, 20250630), ("open", "P", "B", 20250801, 20250929), ("longer", "P", "B", 20250701, 20250831),
           ("blocked", "P", "B", 20250701, 20250831)]
    new = [*old[:2], ("longer", "P", "B", 20250701, 20250930), old[3], ("blocked", "Q", "B", 20251005, 20251020), ("coming", "P", "B", 20251101, 20251120)]
    before, after = windows(spark, old, replace(settings, as_of=upto), "old", folder), windows(spark, new, replace(settings, as_of=now), "new", folder)
    cut = {r.OutletIdentifier: r.after_window_end for r in before.collect()}
    assert cut["open"] == upto < {r.OutletIdentifier: r.after_window_end for r in after.collect()}["open"]
    assert bag(increments.changed_places(before, after, upto)) == [("blocked", "B"), ("longer", "B")]
    assert increments.changed_places(after, after, now).count() == 0


def test_first_run_and_nothing_new(spark, settings):
    rng = random.Random(7)
    folder, loyalty = stage_folder(spark), lines(spark, rng, 300)
    after = windows(spark, rates(rng), settings, "w", folder)
    full = rollup_by_customer(tag_transactions(loyalty, after, settings))
    none = loyalty.limit(0)
    first = increments.update_rollup(full.limit(0), after.limit(0), after, none, loyalty, settings, date(2024, 1, 1))
    assert bag(first) == bag(full)
    assert bag(increments.update_rollup(stage(full, folder, "full"), after, after, loyalty, none, settings, date(2030, 1, 1))) == bag(full)


def test_changed_places_may_be_given(spark, settings):
    """Changed places that were stored give the same rollup as those computed on the way."""
    rng = random.Random(5)
    folder, all_rates = stage_folder(spark), rates(rng)
    loyalty = stage(lines(spark, rng), folder, "loyalty")
    days = [FIRST + timedelta(days=150), FIRST + timedelta(days=1000)]
    before, after = (state(spark, settings, [r for r in all_rates if r[3] <= key(day)], day, folder) for day in days)
    then, now = loyalty.filter(F.col("DateKey") <= key(days[0])), loyalty.filter(F.col("DateKey") > key(days[0]))
    kept = stage(rollup_by_customer(tag_transactions(then, before, settings)), folder, "rollup_0")
    changed = stage(increments.changed_places(before, after, days[0]), folder, "changed")
    arguments = (kept, before, after, then, now, settings, days[0])
    given = increments.update_rollup(*arguments, broadcast_rows=1000, changed=changed)
    assert changed.count() and bag(given) == bag(increments.update_rollup(*arguments))


def test_windows_are_compared_whole_before_their_spans(spark, settings):
    """A promotion is shuffled as one row a side; spans that only changed rows with an equal promotion are no change."""
    one = promos(spark, [("O", "P", "B", 20250610, 20250619), ("Q", "P", "B", 20250610, 20250619)], settings)
    marked = detect_overlaps(one, settings)
    none = marked.withColumns({f"has_{side}_window": F.lit(False) for side in ("before", "after")})
    apart = marked.withColumns({"has_before_window": F.lit(False)}).unionByName(marked.withColumns({"has_after_window": F.lit(False)}))
    upto = date(2026, 1, 1)
    assert increments.changed_places(marked.unionByName(none), apart, upto).count() == 0
    moved = apart.unionByName(marked.filter("OutletIdentifier = 'Q'"))
    assert bag(increments.changed_places(marked.unionByName(none), moved, upto)) == [("Q", "B")]
    text = spark._jvm.PythonSQLUtils.explainString(increments.changed_places(marked, none, upto)._jdf.queryExecution(), "formatted")
    shuffled = [part for part in text.split("\n(") if ") Exchange" in part.splitlines()[0]]
    assert any("before_promo_first#" in part and "after_promo_last#" in part for part in shuffled)
