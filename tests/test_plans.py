"""Shapes of the physical plans that the design relies on."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from promolens.operators.metrics import rollup_by_customer, widen_rollup
from promolens.operators.overlap import detect_overlaps
from promolens.operators.tagging import tag_transactions
from promolens.plans.stages import Stages
from promolens.sources.sample import SETTINGS, sample_catalog
from tests.helpers import promos, span


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stages(spark):
    return Stages(sample_catalog(spark, "/root/testdata/sf0.001"), SETTINGS)


def test_no_python_and_no_cross_join(stages):
    for df in (stages.metrics, stages.windows, stages.loyalty_all):
        text = plan(df)
        assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_tagging_scans_the_sales_once(stages):
    text = plan(stages.tagged)
    assert text.count("FileScan parquet [l_orderkey") == 1
    assert "Union" not in text


def test_all_checks_scan_the_sales_twice(spark, tmp_path):
    """On stored sales: one pass for the lines, one for the loyalty lines."""
    catalog = sample_catalog(spark, "/root/testdata/sf0.001")
    catalog.table("scan").write.parquet(str(tmp_path / "scan"))
    catalog.locations["scan"] = str(tmp_path / "scan")
    stored = Stages(catalog, SETTINGS)
    from promolens.plans.queries import QUERIES

    def scans(df):
        return sum("FileScan" in line and f"{tmp_path}/scan]" in line for line in plan(df).splitlines())

    length = "spark.sql.maxMetadataStringLength"  # else a long folder's name is cut off in the plan
    before = spark.conf.get(length)
    spark.conf.set(length, "10000")
    try:
        assert scans(QUERIES["quality_all"](stored)) == 2
        assert scans(QUERIES["quality_coverage"](stored)) == 1
        assert scans(QUERIES["quality_loyalty"](stored)) == 1
        assert scans(stored.scan.unionByName(stored.scan).unionByName(stored.scan)) == 3
    finally:
        spark.conf.set(length, before)


def test_drilldown_filters_the_rates(stages):
    text = plan(stages.place("000007", "Brand#11"))
    assert "EqualTo(p_brand,Brand#11)" in text


def test_only_needed_columns_are_read(stages):
    text = plan(stages.metrics)
    scan = next(line for line in text.splitlines() if "FileScan parquet [l_orderkey" in line)
    columns = scan.split("[", 1)[1].split("]", 1)[0]
    assert "l_tax" not in columns and "l_returnflag" not in columns


def test_valid_loyalty_turns_the_left_join_inner(stages):
    assert "LeftOuter" not in plan(stages.loyalty_valid)


def test_wide_metrics_take_two_shuffles(spark):
    tagged = spark.sql(
        "SELECT 'O' AS OutletIdentifier, 'B' AS ReportingBrandName, 'P' AS PromotionName, "
        "DATE '2025-01-01' AS PromoTrueStartDate_dt, DATE '2025-01-02' AS PromoTrueEndDate_dt, "
        "CAST(id AS STRING) AS LoyaltyCode, id AS MetricVolume, id AS MetricValue, 'during_promo' AS period "
        "FROM range(0, 100, 1, 4)"
    )
    text = plan(widen_rollup(rollup_by_customer(tagged)))
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("partial_sum") >= 2


def test_overlap_frames_grow_and_never_look_ahead(spark, settings):
    df = detect_overlaps(promos(spark, [("O", "P", "B", *span(date(2025, 6, 1), 30))], settings), settings)
    text = plan(df)
    assert "RangeFrame, unboundedpreceding$(), -1" in text
    assert "unboundedfollowing" not in text


def test_hot_place_is_split(spark, settings):
    """Most sales at one outlet, brand and month: adaptive execution must be free to split it."""
    changed = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {name: spark.conf.get(name, None) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        windows = detect_overlaps(
            promos(
                spark,
                [(f"O{i}", "P", "B", *span(date(2025, 6, 1), 30)) for i in range(200)]
                + [("hot", "P", "B", *span(date(2025, 6, 1), 30))],
                settings,
            ),
            settings,
        )
        loyalty = spark.range(0, 60_000, 1, 8).select(
            F.expr("CASE WHEN id % 3 = 0 THEN concat('O', id % 200) ELSE 'hot' END AS OutletIdentifier"),
            F.lit("B").alias("ReportingBrandName"),
            F.expr("CAST(20250601 + id % 30 AS INT) AS DateKey"),
            F.expr("concat('c', id) AS LoyaltyCode"),
            F.expr("CAST(1 AS DECIMAL(18,2)) AS MetricVolume"),
            F.expr("CAST(1 AS DECIMAL(18,2)) AS MetricValue"),
        )
        rollup = rollup_by_customer(tag_transactions(loyalty, windows, settings))
        rows = rollup.collect()
        assert len(rows) == 60_000
        assert "SortMergeJoin(skew=true)" in plan(rollup)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def test_checks_read_stored_metrics(stages):
    """Three layers read the metrics of the promotions, which are made once, not in the checks' own plan."""
    from promolens.plans.queries import QUERIES

    text = plan(QUERIES["quality_all"](stages))
    assert "AS before_promo_total_volume" not in text and "before_promo_total_volume" in text
