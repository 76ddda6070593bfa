from __future__ import annotations

import random
from datetime import date

import pytest

from promolens.operators import customers
from promolens.schemas import BRAND, OUTLET
from promolens.sources.sink import stage, stage_folder
from tests.conftest import bag

ROLLUP = """OutletIdentifier string, ReportingBrandName string, PromotionName string,
    PromoTrueStartDate_dt date, PromoTrueEndDate_dt date, period string, LoyaltyCode string"""
LEVELS = [[BRAND], [BRAND, "period"], ["period"], []]


def rollup(spark, seed, n=3000, people=700):
    """A third of the rows of one promotion, a third of one customer; null brands and codes."""
    rng, rows = random.Random(seed), set()
    for _ in range(n):
        outlet, brand, promo = ("o1", "B", "P") if rng.random() < 0.33 else (f"o{rng.randrange(9)}", rng.choice(["B", "C", None]), rng.choice("PQR"))
        code = "regular" if rng.random() < 0.33 else rng.choice([None, *(f"c{k}" for k in range(people))])
        rows.add((outlet, brand, promo, date(2025, 1, 1), date(2025, 1, 9), rng.choice(["before_promo", "during_promo"]), code))
    return sorted(rows, key=repr)


def plain(rows, level):
    seen: dict = {}
    for outlet, brand, promo, _, _, period, code in rows:
        if code is not None:
            group = tuple({OUTLET: outlet, BRAND: brand, "period": period}[c] for c in level)
            seen.setdefault(group, set()).add(code)
    return {group: len(codes) for group, codes in seen.items()}


def counted(sets, levels=LEVELS):
    found = customers.distinct_customers(sets, levels).collect()
    return {(r.level, tuple(r[c] for c in (r.level.split(",") if r.level != "all" else []))): r.customers for r in found}, len(found)


def wanted(rows):
    return {(",".join(level) or "all", group): n for level in LEVELS for group, n in plain(rows, level).items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_are_exact_and_add_up(spark, seed):
    rows = rollup(spark, seed)
    old, new = rows[: len(rows) // 2], rows[len(rows) // 2 :]
    folder = stage_folder(spark)
    frames = [spark.createDataFrame(part, ROLLUP) for part in (old, new, rows)]
    first = stage(customers.number_customers(frames[0]), folder, "first")
    sets = stage(customers.customer_sets(frames[0], first), folder, "sets")
    assert counted(sets)[0] == wanted(old)
    grown = stage(customers.number_customers(frames[1], first), folder, "grown")
    assert set(bag(first)) <= set(bag(grown))
    assert grown.count() == grown.select("LoyaltyCode").distinct().count() == grown.select("number").distinct().count()
    more = customers.customer_sets(frames[1], grown)
    for merged in (customers.merge_sets(sets, more), customers.merge_sets(more, sets, more)):
        found, n = counted(merged)
        assert found == wanted(rows) and n == len(found)  # no group twice, null brands told from missing columns


def test_neighbours_share_words(spark):
    """Customers of one outlet are numbered in a row, so its promotions need few words."""
    rows = [(f"o{k // 640}", "B", "P", date(2025, 1, 1), date(2025, 1, 2), "during_promo", f"c{k * 7919 % 100003}") for k in range(3200)]
    frame = spark.createDataFrame(rows, ROLLUP)
    names = stage(customers.number_customers(frame), stage_folder(spark), "names")
    assert customers.customer_sets(frame, names).count() < 3200 / 16


def test_nothing_and_repeated_levels(spark):
    none = spark.createDataFrame([], ROLLUP)
    names = customers.number_customers(none)
    assert names.count() == 0 and customers.number_customers(none, names).count() == 0
    sets = customers.customer_sets(none, names)
    assert customers.distinct_customers(sets, LEVELS).count() == 0
    with pytest.raises(ValueError, match="twice"):
        customers.distinct_customers(sets, [[BRAND], [BRAND]])
