from __future__ import annotations

from datetime import datetime

from promolens.quality.history import audit_drift, run_values, value_drift
from promolens.quality.report import CHECK_SCHEMA, save_audit

CHECK = "layer string, check_name string, passed boolean, value double"
RUNS = CHECK + ", run_id string"


def judge(spark, values, now, **options):
    past = spark.createDataFrame([("l", "c", True, v, f"r{k}") for k, v in enumerate(values)], RUNS)
    current = run_values(spark.createDataFrame([("l", "c", True, now)], CHECK), "now")
    return value_drift(current, past, **options).first()


def test_tenfold_jump_of_a_passing_check_is_flagged(spark):
    steady = [100.0, 104.0, 98.0, 101.0, 99.0]
    assert judge(spark, steady, 1000.0).drifted and judge(spark, steady, 10.0).drifted
    assert judge(spark, steady, 103.0).drifted is False and judge(spark, steady, 103.0).passed
    row = judge(spark, steady, 100.0)
    assert (row.runs, row.usual, row.low, row.high) == (5, 100.0, 50.0, 150.0)


def test_equal_and_wide_pasts(spark):
    assert judge(spark, [5.0] * 4, 6.0).drifted is False and judge(spark, [5.0] * 4, 50.0).drifted
    assert judge(spark, [0.0] * 4, 0.0).drifted is False and judge(spark, [0.0] * 4, 1.0).drifted
    assert judge(spark, [1.0, 100.0, 50.0, 300.0], 500.0).drifted is False
    assert judge(spark, [1.0, 100.0, 50.0, 300.0], 500.0, spread=1.0).drifted
    assert judge(spark, [-10.0] * 3, -100.0).drifted


def test_too_little_to_judge_by(spark):
    assert judge(spark, [1.0, 1.0], 10.0).drifted is None and judge(spark, [], 1.0).runs == 0
    assert judge(spark, [1.0, None, None, 1.0], 10.0).drifted is None
    assert judge(spark, [1.0] * 3, None).drifted is None


def test_own_run_and_repeated_runs(spark):
    """Judging after the run was saved, or after one was saved twice, changes nothing."""
    past = [("l", "c", True, v, f"r{k}") for k, v in enumerate([10.0, 11.0, 12.0])]
    current = run_values(spark.createDataFrame([("l", "c", True, 100.0)], CHECK), "now")
    rows = [value_drift(current, spark.createDataFrame(h, RUNS)).collect() for h in (past, past + past[:1], [*past, ("l", "c", True, 100.0, "now")])]
    assert rows[0] == rows[1] == rows[2] and rows[0][0].drifted


def test_latest_run_of_an_audit_table(spark):
    def save(day, *values):
        rows = [("l", f"c{k}", "error", True, "", v, None, datetime(2025, 1, day)) for k, v in enumerate(values)]
        save_audit(spark.createDataFrame(rows, CHECK_SCHEMA), "drift_audit")

    for day in (1, 2, 3):
        save(day, 10.0 + day, 7.0)
    save(4, 130.0, 7.0)
    found = {r.check_name: r for r in audit_drift(spark.table("drift_audit")).collect()}
    assert found["c0"].drifted and found["c0"].passed and found["c0"].runs == 3 and found["c1"].drifted is False
    save(5, 12.0, 700.0)
    found = {r.check_name: r for r in audit_drift(spark.table("drift_audit")).collect()}
    assert found["c0"].drifted is False and found["c1"].drifted and found["c1"].runs == 4
    assert audit_drift(spark.table("drift_audit").limit(0)).count() == 0
