"""A full run: staged tables, checks, and the saved metrics table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from promolens.config import Settings
from promolens.operators import reports
from promolens.operators.metrics import add_derived_metrics, keep_all_promos, widen_rollup
from promolens.plans.stages import Stages
from promolens.quality.core import ERROR
from promolens.quality.guards import guard_metrics, violations
from promolens.quality.history import audit_drift
from promolens.quality.report import QualityReport, check_frames, evaluate, save_audit
from promolens.sources.catalog import Catalog
from promolens.sources.sink import remove_folder, save_loyalty_scan, save_metrics, stage


@dataclass(frozen=True)
class Analysis:
    """Results of a run. ``checks`` is empty if the run was told not to check.

    The frames read the run's staged tables; :meth:`close`, or leaving a ``with`` block, removes those. ``drift`` holds the
    latest run's checks beside those of earlier runs, if an audit table was named.
    """

    metrics: DataFrame
    windows: DataFrame
    checks: dict[str, QualityReport]
    summaries: dict[str, DataFrame]
    folder: str
    drift: DataFrame | None = None

    def close(self) -> None:
        remove_folder(self.metrics.sparkSession, self.folder)

    def __enter__(self) -> Analysis:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def run(
    catalog: Catalog,
    settings: Settings,
    promo_input: str = "single_promo",
    table_name: str | None = None,
    audit_table: str | None = None,
    check: bool = True,
    raise_on_failure: bool = True,
    loyalty_input: str = "scan",
    loyalty_table: str | None = None,
    separator: str = "",
    every_promo: bool = False,
    expected_keys: tuple[int, int] | None = None,
    lift_severity: str = ERROR,
) -> Analysis:
    """Compute the metrics of every promotion, check them, and save them if a table is named.

    The scan is read for tagging, and with checks twice more: once for the lines, once for the loyalty lines with
    their coverage. All else is read from stored results. ``loyalty_table`` saves the loyalty lines, in one more
    pass, for runs with ``loyalty_input="loyalty_scan"``; ``every_promo`` also lists promotions without sales. A lift
    out of range fails the run before it saves; ``lift_severity="warn"`` lets ordinary extreme lifts pass.
    """
    stages = Stages(catalog, settings, promo_input, loyalty_input, separator)
    promos, windows, rollup = (stages.kept(name) for name in ("promos", "windows", "rollup"))
    wide = widen_rollup(rollup)
    metrics = stage(add_derived_metrics(keep_all_promos(wide, windows) if every_promo else wide), stages.folder, "metrics")

    checks: dict[str, QualityReport] = {}
    drift: DataFrame | None = None
    if check:
        from_scan = loyalty_input == "scan"
        frames = check_frames(
            stages.scan,
            stages.table("outlet"),
            stages.table("product"),
            stages.table("promo_master"),
            stages.loyalty_all,
            None if from_scan else stages.loyalty_valid,
            promos,
            windows,
            rollup,
            metrics,
            settings,
            expected_keys,
            stages.totals,
            coverage=True,
            lift_severity=lift_severity,
            ledger=stages.kept("ledger"),
            derived=from_scan,
        )
        checks = evaluate(frames, raise_on_failure=False)
        if audit_table is not None:
            for report in checks.values():
                save_audit(report.as_frame(catalog.spark), audit_table)
            drift = audit_drift(catalog.spark.table(audit_table))
        if raise_on_failure:
            for report in checks.values():
                report.raise_if_failed()
    if loyalty_table is not None:
        save_loyalty_scan(stages.loyalty_valid, loyalty_table)
    if table_name is not None:
        with violations():
            save_metrics(guard_metrics(metrics), table_name)
    summaries = {
        "discounts": reports.discount_summary(stages.scan),
        "loyalty": reports.loyalty_summary(stages.loyalty_all),
        "promo_windows": reports.promo_windows_summary(promos),
        "overlaps": reports.overlap_summary(windows),
        "tagging": reports.tagging_summary(rollup),
        "metrics": reports.metrics_summary(metrics),
        "top_brands": reports.top_brands(metrics),
    }
    return Analysis(metrics, windows, checks, summaries, stages.folder, drift)
