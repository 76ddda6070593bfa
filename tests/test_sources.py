from __future__ import annotations

from dataclasses import replace

import pytest

from promolens.plans.stages import Stages
from promolens.schemas import TABLES
from promolens.sources.catalog import DEFAULT_LOCATIONS, Catalog
from promolens.sources.loaders import VIEWS, load, load_all, load_scan_table
from promolens.sources.sink import remove_folder, restore_previous, save_metrics, stage, stage_folder


def test_every_view_has_a_default_location():
    assert {view.table for view in VIEWS.values()} == set(DEFAULT_LOCATIONS) == set(TABLES)


def test_path_table_and_frame_locations(spark, settings, tmp_path):
    frame = spark.sql(
        "SELECT 20250102 AS DateKey, DATE '2024-12-30' AS WeekStartDate, DATE '2025-01-05' AS WeekEndDate, "
        "2025 AS CalendarYearNumber, 202501 AS CalendarYearMonthNumber, 'x' AS extra"
    )
    frame.write.parquet(str(tmp_path / "days"))
    frame.write.saveAsTable("dim_days")
    for location in (str(tmp_path / "days"), "dim_days", frame, lambda _: frame):
        df = load(Catalog(spark, {"date": location}), "date", settings)
        assert df.columns == TABLES["date"].fieldNames()
        assert df.count() == 1


def test_missing_columns_are_named(spark, settings):
    catalog = Catalog(spark, {"date": spark.sql("SELECT 1 AS DateKey")})
    with pytest.raises(ValueError, match="WeekStartDate"):
        load(catalog, "date", settings)


def test_other_kinds_of_type_are_cast(spark, settings):
    columns = {f.name: f"CAST(NULL AS {f.dataType.simpleString()})" for f in TABLES["scan"]}
    columns |= {"LoyaltyNumber": "12345L", "DateKey": "20250101L", "MetricVolume": "2D"}
    frame = spark.sql("SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in columns.items()))
    df = load_scan_table(Catalog(spark, {"scan": frame}), settings)
    types = dict(df.dtypes)
    assert types["LoyaltyNumber"] == "string"
    assert (types["DateKey"], types["MetricVolume"]) == ("bigint", "double")


def test_filters_reach_the_file_scan(spark, settings, tmp_path):
    columns = {f.name: f"CAST(NULL AS {f.dataType.simpleString()})" for f in TABLES["scan"]}
    frame = spark.sql("SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in columns.items()))
    frame.write.parquet(str(tmp_path / "scan"))
    df = load_scan_table(Catalog(spark, {"scan": str(tmp_path / "scan")}), settings)
    plan = df.select("OutletKey", "DateKey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(DateKey,20250101)" in plan
    assert "ReadSchema: struct<OutletKey:bigint,DateKey:int>" in plan


def test_load_all_is_lazy_and_complete(spark):
    from promolens.sources.sample import SETTINGS, sample_catalog

    tables = load_all(sample_catalog(spark, "/root/testdata/sf0.001"), SETTINGS)
    assert list(tables) == list(VIEWS)


def test_stage_needs_a_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert stage_folder(spark).startswith(shared)
    assert stage_folder(spark) != stage_folder(spark)
    staged = stage(spark.range(5), stage_folder(spark), "five")
    assert staged.count() == 5 and "Scan parquet" in staged._jdf.queryExecution().executedPlan().toString()


def test_saved_table_keeps_and_gains_columns(spark):
    save_metrics(spark.sql("SELECT 'a' AS k, 1 AS old, CAST(1.5 AS DECIMAL(9,2)) AS amount"), "evolving")
    save_metrics(spark.sql("SELECT CAST(2.25 AS DECIMAL(9,2)) AS amount, 'b' AS k, 9 AS added"), "evolving")
    table = spark.table("evolving")
    assert table.columns == ["k", "old", "amount", "added"]
    assert [tuple(r) for r in table.collect()] == [("b", None, 2.25, 9)]
    save_metrics(spark.sql("SELECT 'c' AS k, 3 AS old"), "evolving")
    assert [tuple(r) for r in spark.table("evolving").collect()] == [("c", 3, None, None)]


def _location(spark, table):
    return next(r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r.col_name == "Location")


def _half_way(spark):
    """Rows of which the last can't be computed, after others are written."""
    return spark.range(0, 100, 1, 4).selectExpr("CASE WHEN id = 99 THEN raise_error('half way') ELSE 'new' END AS k", "CAST(id AS INT) AS v")


def test_failed_replacement_leaves_the_old_rows(spark, tmp_path):
    for table, path in (("failing", None), ("failing_at_path", str(tmp_path / "t"))):
        save_metrics(spark.sql("SELECT 'a' AS k, 1 AS v"), table, path)
        before = _location(spark, table)
        reader = spark.table(table)
        with pytest.raises(Exception, match="half way"):
            save_metrics(_half_way(spark), table)

        def refuse(rows):
            assert rows.count() == 2
            raise ValueError("not these")

        with pytest.raises(ValueError, match="not these"):
            save_metrics(spark.sql("SELECT 'b' AS k, 2 AS v UNION ALL SELECT 'c', 3"), table, check=refuse)
        assert _location(spark, table) == before
        assert [tuple(r) for r in spark.table(table).collect()] == [("a", 1)] == [tuple(r) for r in reader.collect()]
    assert not list((tmp_path / "t_versions").iterdir())


def test_replacement_keeps_the_last_version_only(spark, tmp_path):
    table = "versioned"
    save_metrics(spark.sql("SELECT 1 AS v"), table, str(tmp_path / "t"))
    begun = spark.table(table)
    save_metrics(spark.sql("SELECT 2 AS v"), table)
    assert [r.v for r in begun.collect()] == [1]  # a reader that began before
    save_metrics(spark.sql("SELECT 3 AS v"), table, check=lambda rows: rows.count())
    assert len(list((tmp_path / "t_versions").iterdir())) == 2 and not (tmp_path / "t").exists()
    restore_previous(spark, table)
    assert [r.v for r in spark.table(table).collect()] == [2]
    restore_previous(spark, table)
    assert [r.v for r in spark.table(table).collect()] == [3]
    save_metrics(spark.sql("SELECT 1 AS v"), "unversioned")
    with pytest.raises(ValueError, match="no earlier rows"):
        restore_previous(spark, "unversioned")


def test_refused_new_table_is_not_created(spark):
    with pytest.raises(ZeroDivisionError):
        save_metrics(spark.sql("SELECT 1 AS v"), "never", check=lambda rows: 1 // 0)
    assert not spark.catalog.tableExists("never")


def test_failed_replacement_of_a_partitioned_table(spark):
    spark.sql("SELECT 1 AS v, 'old' AS k").write.partitionBy("k").saveAsTable("parted_failing")
    with pytest.raises(Exception, match="half way"):
        save_metrics(_half_way(spark), "parted_failing")
    assert [tuple(r) for r in spark.table("parted_failing").collect()] == [(1, "old")]


def test_partitioned_table_keeps_no_old_rows(spark):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        spark.sql("SELECT 1 AS v, 'old' AS p").write.partitionBy("p").saveAsTable("parted")
        save_metrics(spark.sql("SELECT 2 AS v, 'new' AS p"), "parted")
        assert [tuple(r) for r in spark.table("parted").collect()] == [(2, "new")]
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_staged_folder_can_be_removed(spark):
    folder = stage_folder(spark)
    stage(spark.range(5), folder, "five")
    remove_folder(spark, folder)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{folder}/five")


class _Cluster:
    """What stage_folder asks of a session, for one that is not local."""

    class sparkContext:
        master = "spark://host:7077"

    class conf:
        @staticmethod
        def get(name, default=None):
            return "file:/tmp/shared"


def test_cluster_refuses_a_local_folder():
    with pytest.raises(ValueError, match="on one machine"):
        stage_folder(_Cluster())


def test_unknown_promo_input(spark, settings):
    with pytest.raises(ValueError):
        Stages(Catalog(spark), replace(settings), promo_input="neither")
