"""Every named query against its SQL, on the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from promolens.operators.metrics import rollup_by_customer
from promolens.plans.analysis import run
from promolens.plans.queries import QUERIES, as_doubles
from promolens.plans.stages import Stages
from promolens.sources.sample import SETTINGS, sample_catalog
from tests.conftest import bag
from verification.compare import connect, rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duckdb_tables():
    return connect(FOLDER)


def test_same_names():
    assert list(entry.queries())[: len(QUERIES)] == list(QUERIES)
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def stages(spark):
    """Shared by the queries, so that what several read is stored once."""
    return Stages(sample_catalog(spark, FOLDER), SETTINGS)


def test_entry(spark):
    assert entry.entry(spark).count() == 491
    assert entry.queries()["overlap_summary"](spark, FOLDER).first().total_promotions == 664


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(stages, duckdb_tables, name):
    got = as_doubles(QUERIES[name](stages)).toPandas()
    want = duckdb_tables.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
    assert len(got)


def test_known_counts(spark, stages):
    assert stages.scan.count() == 4234
    assert stages.loyalty_valid.count() == 1997
    assert stages.kept("promos").count() == 664
    tagged = {r.period: r["count"] for r in stages.tagged.groupBy("period").count().collect()}
    assert tagged == {"before_promo": 80, "during_promo": 594, "after_promo": 97}
    joined = Stages(sample_catalog(spark, FOLDER), SETTINGS, promo_input="joined")
    assert joined.promos.count() == 442


def test_full_run(spark):
    result = run(
        sample_catalog(spark, FOLDER), SETTINGS, table_name="run_metrics", audit_table="run_audit", raise_on_failure=False
    )
    assert spark.table("run_metrics").count() == result.metrics.count() == 491
    bad = [r.check_name for report in result.checks.values() for r in report.failed]
    assert bad == ["volume_lift_reasonable"]
    assert spark.table("run_audit").count() == 66
    assert result.drift.count() == 66 and result.drift.filter("runs > 0 OR drifted IS NOT NULL").count() == 0
    assert {name: df.count() for name, df in result.summaries.items()}["tagging"] == 4
    with pytest.raises(ValueError, match="volume_lift_reasonable"):
        run(sample_catalog(spark, FOLDER), SETTINGS)


def test_run_from_saved_loyalty_lines(spark):
    with run(sample_catalog(spark, FOLDER), SETTINGS, loyalty_table="saved_loyalty", lift_severity="warn") as first:
        want = bag(first.metrics)
        share = first.checks["coverage"].results[0].value
    with pytest.raises(Exception, match="FAILED_READ_FILE|does not exist|PATH_NOT_FOUND"):
        first.metrics.collect()
    catalog = sample_catalog(spark, FOLDER)
    catalog.locations["loyalty_scan"] = "saved_loyalty"
    options = {"loyalty_input": "loyalty_scan", "lift_severity": "warn", "every_promo": True, "check": True}
    with run(catalog, SETTINGS, **options) as again:
        assert bag(again.metrics.filter("during_promo_total_volume IS NOT NULL OR before_promo_total_volume IS NOT NULL OR after_promo_total_volume IS NOT NULL")) == want
        assert again.metrics.count() == 664 and again.checks["coverage"].results[0].value == share
    with pytest.raises(ValueError, match="date_range_covered"):
        run(catalog, SETTINGS, lift_severity="warn", expected_keys=(19000101, 29991231))
    with pytest.raises(ValueError, match="loyalty_input"):
        run(catalog, SETTINGS, loyalty_input="neither")


def test_rollup_is_exact(stages):
    assert rollup_by_customer(stages.tagged).agg({"tagged_rows": "sum"}).first()[0] == 771
