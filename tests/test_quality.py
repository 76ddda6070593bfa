from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from promolens.operators.discounts import add_discount_columns
from promolens.operators.metrics import calculate_metrics, rollup_by_customer, widen_rollup
from promolens.operators.overlap import detect_overlaps
from promolens.quality import layers, validators
from promolens.quality.core import measure
from promolens.quality.report import QualityReport, check_frames, evaluate, run_all_quality_checks, save_audit
from promolens.schemas import TABLES
from tests.helpers import chain
from tests.test_metrics import AFTER, BEFORE, DURING, TAGGED, tagged


def failed(checks):
    return sorted(r.check_name for r in checks.filter("NOT passed").collect())


def table(spark, name, *rows):
    """Rows given as dictionaries of SQL literals, other columns null."""
    schema = TABLES[name]
    selects = [
        "SELECT " + ", ".join(f"CAST({row.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema)
        for row in rows
    ]
    return spark.sql(" UNION ALL ".join(selects))


def scan(spark, **changes):
    line = {"OutletKey": 1, "ProductKey": 1, "DateKey": 20250601, "ManufacturerDiscountValue": 1, "CouponDiscountValue": 0,
            "SubmitterName": "'A'", **changes}
    return add_discount_columns(table(spark, "scan", line))


def dimensions(spark):
    return [
        table(spark, "outlet", {"OutletKey": 1}),
        table(spark, "product", {"ProductKey": 1}),
        table(spark, "promo_master", {"PromotionStatus": "'Closed'"}),
    ]


@pytest.mark.parametrize(
    ("changes", "expected"),
    [
        ({}, []),
        ({"DateKey": 20241231}, ["scan_date_filter_applied"]),
        ({"OutletKey": "NULL"}, ["no_null_outlet_keys"]),
        ({"ProductKey": "NULL"}, ["no_null_product_keys"]),
    ],
)
def test_source_checks_on_the_scan(spark, settings, changes, expected):
    assert failed(layers.check_source_data(scan(spark, **changes), *dimensions(spark), settings)) == expected


def test_source_checks_on_dimensions(spark, settings):
    outlet, product, promo = dimensions(spark)
    twice = outlet.union(outlet)
    draft = table(spark, "promo_master", {"PromotionStatus": "'Draft'"}, {"PromotionStatus": "NULL"})
    checks = layers.check_source_data(scan(spark), twice, product.drop("ReportingBrandName"), draft, settings, (20250101, 20250701))
    assert failed(checks) == ["date_range_covered", "dates_without_gaps", "product_columns_present", "promo_status_filtered", "unique_outlet_key"]
    values = {r.check_name: r.value for r in checks.collect()}
    assert (values["promo_status_filtered"], values["unique_outlet_key"]) == (2, 1)


def test_empty_inputs_fail_without_errors(spark, settings):
    empty = [df.limit(0) for df in (scan(spark), *dimensions(spark))]
    assert failed(layers.check_source_data(*empty, settings)) == [
        "date_range_covered", "outlet_table_not_empty", "product_table_not_empty", "promo_table_not_empty", "scan_table_not_empty",
    ]
    nobody = spark.createDataFrame([], "SubmitterName string, LoyaltyCode string")
    assert failed(layers.check_loyalty_derivation(nobody, nobody)) == ["loyalty_derivation_rate"]
    none = tagged(spark, [DURING]).limit(0)
    metrics = calculate_metrics(none, save_to_table=False)
    assert failed(layers.check_tagged_transactions(none)) == []
    assert failed(layers.check_final_metrics(metrics)) == []
    assert failed(layers.check_reconciliation(none, metrics)) == []


@pytest.mark.parametrize(
    ("column", "value", "expected"),
    [
        ("SMP_discount", "-1", ["no_negative_smp"]), ("MP_discount", "-1", ["no_negative_mp"]),
        ("CPN_discount", "-1", ["no_negative_cpn"]), ("is_promo", "2", ["is_promo_valid"]), ("is_promo", "NULL", ["is_promo_valid"]),
    ],
)
def test_discount_checks(spark, column, value, expected):
    df = scan(spark)
    broken = df.selectExpr(*(c for c in df.columns if c != column), f"CAST({value} AS INT) AS {column}")
    assert failed(layers.check_discount_flags(broken)) == expected
    assert failed(layers.check_discount_flags(df)) == []
    with pytest.raises(AssertionError, match=expected[0]):
        validators.validate_discount_columns(broken)
    assert validators.validate_discount_columns(df) is df


def test_missing_discount_column(spark):
    with pytest.raises(AssertionError, match="discount_columns_present"):
        validators.validate_discount_columns(scan(spark).drop("MP_discount"))


def test_loyalty_checks(spark):
    schema = "SubmitterName string, LoyaltyCode string"
    valid = spark.createDataFrame([("A", "A1"), ("A", "B1"), ("A", None), ("", "")], schema)
    assert failed(layers.check_loyalty_derivation(valid, valid)) == [
        "codes_start_with_submitter", "no_empty_loyalty_codes", "no_null_loyalty_codes",
    ]
    good = valid.limit(1)
    many = spark.range(200).selectExpr("'A' AS SubmitterName", "CAST(NULL AS STRING) AS LoyaltyCode")
    assert failed(layers.check_loyalty_derivation(many, good)) == ["loyalty_derivation_rate"]
    with pytest.raises(AssertionError):
        validators.validate_loyalty_derivation(valid, valid)
    validators.validate_loyalty_derivation(good, good)


@pytest.mark.parametrize(
    ("column", "value", "expected"),
    [
        ("promo_duration_days", "0", ["duration_consistent", "no_negative_durations"]),
        ("promo_duration_days", "7", ["duration_consistent"]),
        ("before_candidate_end", "PromoTrueStartDate_dt", ["before_window_correct"]),
        ("after_candidate_start", "PromoTrueEndDate_dt", ["after_window_correct"]),
        ("PromoTrueEndDate_dt", "PromoTrueStartDate_dt - 1", ["duration_consistent", "start_before_end"]),
    ],
)
def test_window_checks(spark, settings, column, value, expected):
    df = chain(spark, settings)
    broken = df.selectExpr(*(c for c in df.columns if c != column), f"{value} AS {column}")
    assert failed(layers.check_promo_windows(broken)) == expected
    validators.validate_promo_windows(df)
    with pytest.raises(AssertionError):
        validators.validate_promo_windows(broken)


@pytest.mark.parametrize(
    ("column", "value", "expected"),
    [
        ("before_overlap", "2", ["before_overlap_valid"]), ("after_overlap", "NULL", ["after_overlap_valid"]),
        ("before_window_start", "PromoTrueStartDate_dt", ["null_dates_when_invalid"]),
        ("after_window_end", "PromoTrueStartDate_dt", ["null_after_dates_when_invalid"]),
        ("before_window_end", "CAST(NULL AS DATE)", ["before_dates_when_valid"]),
        ("after_window_start", "CAST(NULL AS DATE)", ["after_dates_when_valid"]),
    ],
)
def test_overlap_checks(spark, settings, column, value, expected):
    promos = chain(spark, settings)
    windows = detect_overlaps(promos, settings)
    broken = windows.selectExpr(*(c for c in windows.columns if c != column), f"{value} AS {column}")
    assert failed(layers.check_overlap_detection(promos, broken)) == expected
    assert failed(layers.check_overlap_detection(promos, windows)) == []
    assert failed(layers.check_overlap_detection(promos.limit(2), windows)) == ["row_count_preserved"]
    with pytest.raises(AssertionError, match=expected[0]):
        validators.validate_overlap_detection(promos, broken)


PROMO = ("000042", "Alba", "Spring", date(2025, 4, 1), date(2025, 9, 29))


@pytest.mark.parametrize(
    ("row", "expected"),
    [
        ((*PROMO, "c", 1, 1, "later"), ["valid_period_values"]),
        ((*PROMO, "c", 1, 1, None), ["no_null_periods"]),
        ((*PROMO, None, 1, 1, "during_promo"), ["no_null_loyalty_codes"]),
        ((None, *PROMO[1:], "c", 1, 1, "during_promo"), ["no_null_outlets"]),
        ((*PROMO, "c", -1, 1, "during_promo"), ["no_negative_volumes"]),
        ((*PROMO, "c", 1, -1, "during_promo"), ["no_negative_values"]),
    ],
)
def test_tagging_checks_agree_with_the_rollup(spark, row, expected):
    row = (*row[:6], Decimal(row[6]), Decimal(row[7]), row[8])
    good = (*PROMO, "c", Decimal(5), Decimal(5), "during_promo")
    df = spark.createDataFrame([row, row, good], TAGGED)
    checks = layers.check_tagged_transactions(df)
    assert failed(checks) == expected
    rolled = layers.check_tagged_transactions(rollup_by_customer(df))
    assert checks.drop("ts").collect() == rolled.drop("ts").collect()
    assert checks.filter("NOT passed").first().value == 2


def test_output_checks(spark):
    metrics = calculate_metrics(tagged(spark, [BEFORE, DURING, AFTER]), save_to_table=False)
    assert failed(layers.check_final_metrics(metrics)) == []
    assert failed(layers.check_final_metrics(metrics.union(metrics))) == ["no_duplicate_rows"]

    def broken(**changes):
        return metrics.selectExpr(*(f"{changes.get(c, c)} AS {c}" for c in metrics.columns))

    assert failed(layers.check_final_metrics(broken(volume_lift_pct="1000.1D"))) == ["volume_lift_reasonable"]
    assert failed(layers.check_final_metrics(broken(customer_retention_rate="-1D"))) == ["retention_reasonable"]
    assert failed(layers.check_final_metrics(broken(value_per_loyal_customer_during="-1D"))) == ["customer_value_reasonable"]
    assert failed(layers.check_final_metrics(broken(PromoTrueEndDate_dt="DATE '2020-01-01'"))) == ["date_ranges_valid"]
    assert failed(layers.check_final_metrics(broken(during_promo_total_volume="-during_promo_total_volume"))) == ["no_negative_during_volume"]
    nothing = broken(PromotionName="CAST(NULL AS STRING)", during_promo_total_volume="CAST(NULL AS DECIMAL(28,2))")
    assert failed(layers.check_final_metrics(nothing)) == ["during_always_present", "no_null_promos"]
    plain = metrics.drop("volume_lift_pct", "customer_retention_rate", "value_per_loyal_customer_during")
    assert layers.check_final_metrics(plain).count() == 10


def test_reconciliation(spark):
    df = tagged(spark, [BEFORE, DURING])
    metrics = calculate_metrics(df, save_to_table=False)
    assert failed(layers.check_reconciliation(df, metrics)) == []
    assert failed(layers.check_reconciliation(rollup_by_customer(df), metrics)) == []
    lost = metrics.selectExpr("* EXCEPT (during_promo_total_value)", "during_promo_total_value * 0.98 AS during_promo_total_value")
    assert failed(layers.check_reconciliation(df, lost)) == ["during_promo_value_reconciles", "value_reconciles"]
    slightly = metrics.selectExpr("* EXCEPT (during_promo_total_value)", "during_promo_total_value * 0.995 AS during_promo_total_value")
    assert failed(layers.check_reconciliation(df, slightly)) == []


def test_rows_lost_between_tagging_and_rollup_show(spark):
    df = tagged(spark, [BEFORE, DURING])
    kept = df.filter("period = 'before_promo'")
    totals = measure(df, layers.tagged_totals())
    found = failed(layers.check_reconciliation(rollup_by_customer(kept), widen_rollup(rollup_by_customer(kept)), totals))
    assert "volume_reconciles" in found and "during_promo_value_reconciles" in found


def test_checks_without_their_column_fail(spark, settings):
    codes = spark.createDataFrame([("WRONG-1",)], "LoyaltyCode string")
    assert failed(layers.check_loyalty_derivation(codes, codes)) == ["codes_start_with_submitter"]
    no_day = layers.check_source_data(scan(spark).drop("DateKey"), *dimensions(spark), settings)
    assert failed(no_day) == ["date_range_covered", "dates_without_gaps", "scan_columns_present", "scan_date_filter_applied"]


def test_range_is_informational_unless_expected(spark, settings):
    def row(*expected):
        checks = layers.check_source_data(scan(spark), *dimensions(spark), settings, *expected)
        return checks.filter("check_name = 'date_range_covered'").first()

    assert row().severity == "info"
    assert (row((20200101, 20991231)).severity, row((20200101, 20991231)).passed) == ("error", False)


def test_loyalty_in_one_pass(spark):
    lines = spark.createDataFrame(
        [("A", "1", "A1"), ("A", "0", None), (None, "1", None), ("A", "2", None), ("A", "3", "B3")],
        "SubmitterName string, LoyaltyNumber string, LoyaltyCode string",
    )
    assert failed(layers.check_loyalty_lines(lines)) == ["codes_start_with_submitter", "no_null_loyalty_codes"]


def everything(spark, settings):
    promos = chain(spark, settings)
    windows = detect_overlaps(promos, settings)
    df = tagged(spark, [BEFORE, DURING, AFTER])
    people = spark.createDataFrame([("A", "A1")], "SubmitterName string, LoyaltyCode string")
    return [scan(spark), *dimensions(spark), people, people, promos, windows, df, calculate_metrics(df, save_to_table=False)]


def test_all_layers_in_one_job(spark, settings):
    frames = everything(spark, settings)
    reports = run_all_quality_checks(*frames, settings=settings)
    assert list(reports) == ["source", "discounts", "loyalty", "windows", "overlap", "tagging", "output", "reconciliation"]
    assert all(r.all_passed for r in reports.values())
    assert sum(len(r.results) for r in reports.values()) == 64
    frames[0] = scan(spark, DateKey=20200101)
    with pytest.raises(ValueError, match="scan_date_filter_applied"):
        run_all_quality_checks(*frames, settings=settings)
    quiet = run_all_quality_checks(*frames, settings=settings, raise_on_failure=False)
    assert (quiet["source"].failed_count, quiet["source"].passed_count) == (1, 15)
    assert "FAIL | scan_date_filter_applied | Lines dated before 20250101: 1" in quiet["source"].summary()


def test_warnings_do_not_fail(spark, settings):
    frames = everything(spark, settings)
    frames[-2] = tagged(spark, [BEFORE])
    frames[-1] = calculate_metrics(frames[-2], save_to_table=False)
    reports = evaluate(check_frames(*frames, settings))
    warned = [r for r in reports["output"].results if not r.passed]
    assert [(r.check_name, r.severity) for r in warned] == [("during_always_present", "warn")]


def test_report_builders_and_audit(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 2), (NULL, -3) AS t(a, b)")
    report = QualityReport("custom").check_no_nulls(df, "b").check_no_nulls(df, "a").check_no_negatives(df, "b")
    assert [str(r) for r in report.results] == [
        "PASS | no_null_b | Null b: 0", "FAIL | no_null_a | Null a: 1", "FAIL | no_negative_b | Negative b: 1",
    ]
    with pytest.raises(ValueError, match="2 quality checks failed"):
        report.raise_if_failed()
    save_audit(report.as_frame(spark), "audit_trail")
    save_audit(report.as_frame(spark), "audit_trail")
    assert spark.table("audit_trail").count() == 6
    with pytest.raises(ValueError):
        QualityReport("empty").frame
