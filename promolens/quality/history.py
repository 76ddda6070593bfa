"""Checks against their own past: does a value that passes still look like those of earlier runs?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHECK = ("layer", "check_name")
#: Runs of a check that make a past; with fewer nothing is judged.
LEAST_RUNS = 3


def run_values(checks: DataFrame, run_id: str) -> DataFrame:
    """The check rows of one run, labelled with its id, for a table of all runs."""
    return checks.withColumns({"run_id": F.lit(run_id)})


def value_drift(current: DataFrame, history: DataFrame, spread: float = 4.0, relative: float = 0.5) -> DataFrame:
    """Every check of the current run beside its past: ``runs``, ``usual`` (the median), the range ``low`` to ``high`` and ``drifted``.

    The range is the quartiles of earlier runs moved out by ``spread`` times their distance, and never closer to the median
    than ``relative`` of its size, since a past of equal values would else flag every change. Runs in ``history`` that carry the
    current ``run_id`` are not its past, so judging again after saving gives the same; a run saved twice counts once. A check
    without a value, or with fewer than LEAST_RUNS earlier values, is not judged: ``drifted`` is null. The quantiles are
    exact: a check has one value a run.
    """
    runs = current.select("run_id").distinct()
    past = history.join(runs, "run_id", "left_anti").groupBy(*CHECK, "run_id").agg(F.max("value").alias("value"))
    quartiles = past.groupBy(*CHECK).agg(
        F.count("value").alias("runs"), F.percentile("value", F.array(*(F.lit(q) for q in (0.25, 0.5, 0.75)))).alias("q")
    )
    near = F.abs(F.col("usual")) * relative
    away = (F.col("q")[2] - F.col("q")[0]) * spread
    ranged = quartiles.withColumns({"usual": F.col("q")[1]}).withColumns(
        {
            "low": F.least(F.col("q")[0] - away, F.col("usual") - near),
            "high": F.greatest(F.col("q")[2] + away, F.col("usual") + near),
        }
    )
    judged = current.select(*CHECK, "passed", "value").join(ranged.drop("q"), list(CHECK), "left")
    known = (F.coalesce("runs", F.lit(0)) >= LEAST_RUNS) & F.col("value").isNotNull()
    return judged.select(
        *CHECK, "passed", "value", F.coalesce("runs", F.lit(0)).alias("runs"), "usual", "low", "high",
        F.when(known, ~F.col("value").between(F.col("low"), F.col("high"))).alias("drifted"),
    )


def audit_drift(audit: DataFrame, spread: float = 4.0, relative: float = 0.5) -> DataFrame:
    """The checks of the latest run in an audit table beside those of the runs before it, as :func:`value_drift` judges them.

    The rows of a run share their time ``ts``, since all of its checks are evaluated in one job.
    """
    runs = audit.withColumns({"run_id": F.col("ts").cast("string")})
    last = audit.agg(F.max("ts").alias("ts"))
    return value_drift(runs.join(F.broadcast(last), "ts", "left_semi"), runs, spread, relative)
