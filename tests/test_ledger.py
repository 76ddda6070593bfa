from __future__ import annotations

import random
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from promolens.operators.metrics import ledger_of, rollup_by_customer, rollup_of, rollup_with_ledger, widen_rollup
from promolens.quality import layers
from promolens.quality.core import measure
from promolens.quality.ledger import differences
from promolens.schemas import PERIODS
from tests.conftest import bag

TAGGED = """OutletIdentifier string, ReportingBrandName string, PromotionName string, PromoTrueStartDate_dt date, PromoTrueEndDate_dt date,
    LoyaltyCode string, MetricVolume decimal(18,2), MetricValue decimal(18,2), period string"""


def sales(spark, n=600, seed=3):
    """A third of the rows are of one place, and codes, amounts and outlets may be null."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        place = ("hot", "B") if rng.random() < 0.33 else (rng.choice(["o1", "o2", "o3", None]), rng.choice(["B", "C"]))
        amounts = [None if rng.random() < 0.05 else Decimal(rng.randrange(-300, 90_000)) / 100 for _ in range(2)]
        rows.append((*place, rng.choice(["P", "Q"]), date(2025, 1, 1), date(2025, 2, 1), rng.choice(["c1", "c2", "c3", None]), *amounts, rng.choice(PERIODS)))
    return spark.createDataFrame(rows, TAGGED)


def test_accounts_hold_rollup_and_ledger(spark):
    tagged = sales(spark)
    accounts = rollup_with_ledger(tagged)
    rollup = rollup_by_customer(tagged)
    assert bag(rollup_of(accounts).select(*rollup.columns)) == bag(rollup)
    want = tagged.groupBy("OutletIdentifier", "ReportingBrandName", "period").agg(
        F.sum("MetricVolume"), F.sum("MetricValue"), F.count("*"), F.count_if(F.col("MetricVolume") < 0), F.count_if(F.col("MetricValue") < 0)
    )
    assert bag(ledger_of(accounts)) == bag(want)
    assert measure(ledger_of(accounts), layers.tagged_totals()).first() == measure(tagged, layers.tagged_totals()).first()
    assert accounts._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_ledgers_of_parts_add_up(spark):
    tagged = sales(spark)
    half = F.xxhash64("LoyaltyCode", "MetricValue") % 2 == 0
    parts = ledger_of(rollup_with_ledger(tagged.filter(half))).unionByName(ledger_of(rollup_with_ledger(tagged.filter(~half))))
    assert differences(parts, widen_rollup(rollup_by_customer(tagged))).count() == 0


def test_the_differing_place_is_found(spark):
    tagged = sales(spark)
    ledger, metrics = ledger_of(rollup_with_ledger(tagged)), widen_rollup(rollup_by_customer(tagged))
    assert differences(ledger, metrics).count() == 0
    cent = F.when((F.col("OutletIdentifier") == "o2") & (F.col("ReportingBrandName") == "C") & (F.col("PromotionName") == "Q"), Decimal("0.01")).otherwise(0)
    changed = metrics.withColumns({"after_promo_total_value": (F.col("after_promo_total_value") + cent).cast("decimal(28,2)")})
    found = differences(ledger, changed).collect()
    assert [(r.OutletIdentifier, r.ReportingBrandName, r.period) for r in found] == [("o2", "C", "after_promo")]
    assert found[0].output_value - found[0].source_value == Decimal("0.01")
    for other in (metrics.filter("OutletIdentifier <> 'hot' OR OutletIdentifier IS NULL"), metrics.unionByName(metrics.filter("OutletIdentifier = 'hot'"))):
        assert {r.OutletIdentifier for r in differences(ledger, other).collect()} == {"hot"}
    assert differences(ledger.limit(0), metrics.limit(0)).count() == 0


def test_a_cent_fails_the_check(spark):
    tagged = sales(spark)
    ledger, metrics = ledger_of(rollup_with_ledger(tagged)), widen_rollup(rollup_by_customer(tagged))
    cent = metrics.withColumns({"during_promo_total_volume": F.col("during_promo_total_volume") + F.when(F.col("PromotionName") == "P", Decimal("0.01")).otherwise(0)})
    totals = measure(ledger, layers.tagged_totals())
    assert layers.check_reconciliation(tagged, metrics, totals, ledger).filter("NOT passed").count() == 0
    wrong = layers.check_reconciliation(tagged, cent, totals, ledger).filter("NOT passed").collect()
    assert [r.check_name for r in wrong] == ["places_reconcile"] and wrong[0].value > 0


def test_doubles_may_differ_by_their_order(spark):
    tagged = sales(spark).withColumns({c: F.col(c).cast("double") / 3 for c in ("MetricVolume", "MetricValue")})
    ledger, metrics = ledger_of(rollup_with_ledger(tagged)), widen_rollup(rollup_by_customer(tagged.orderBy(F.rand(1))))
    assert differences(ledger, metrics).count() == 0
    assert differences(ledger, metrics.withColumns({"during_promo_total_volume": F.col("during_promo_total_volume") + 0.01})).count() > 0


def test_loyalty_lines_of_an_earlier_run_have_no_rate(spark):
    lines = spark.sql("SELECT 'A1' AS LoyaltyCode, 'A' AS SubmitterName")
    names = lambda df: {r.check_name for r in df.collect()}
    assert names(layers.check_loyalty_derivation(lines, lines.filter("true"))) - names(layers.check_loyalty_derivation(lines, lines, derived=False)) == {"loyalty_derivation_rate"}
