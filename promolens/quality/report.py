"""Check results on the driver: a few dozen rows, collected in one job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.config import Settings
from promolens.quality import layers
from promolens.quality.core import ERROR, as_checks, measure, none_of

CHECK_SCHEMA = (
    "layer string, check_name string, severity string, passed boolean, message string, "
    "value double, threshold double, ts timestamp"
)


@dataclass(frozen=True)
class CheckResult:
    layer: str
    check_name: str
    severity: str
    passed: bool
    message: str
    value: float | None
    threshold: float | None
    ts: datetime

    def __str__(self) -> str:
        return f"{'PASS' if self.passed else 'FAIL'} | {self.check_name} | {self.message}"


class QualityReport:
    """Collects check rows and evaluates them together when first asked for a result.

    Only checks of severity ``error`` count as failed; warnings and information are listed.
    """

    def __init__(self, name: str, *frames: DataFrame):
        self.name = name
        self._frames = list(frames)
        self._results: list[CheckResult] | None = None

    @property
    def frame(self) -> DataFrame:
        """The check rows, for an audit table."""
        if not self._frames:
            raise ValueError(f"report {self.name!r} has no checks")
        return reduce(DataFrame.unionByName, self._frames)

    def add(self, checks: DataFrame) -> QualityReport:
        self._frames.append(checks)
        self._results = None
        return self

    def check_no_nulls(self, df: DataFrame, column: str) -> QualityReport:
        nulls = measure(df, {"nulls": f"count_if(`{column}` IS NULL)"})
        check = none_of(f"no_null_{column}", f"Null {column}", "nulls")
        return self.add(as_checks(self.name, nulls, [check]))

    def check_no_negatives(self, df: DataFrame, column: str) -> QualityReport:
        below = measure(df, {"below": f"count_if(`{column}` < 0)"})
        check = none_of(f"no_negative_{column}", f"Negative {column}", "below")
        return self.add(as_checks(self.name, below, [check]))

    @property
    def results(self) -> list[CheckResult]:
        if self._results is None:
            self._results = [CheckResult(**row.asDict()) for row in self.frame.collect()]
        return self._results

    def as_frame(self, spark: SparkSession) -> DataFrame:
        """The evaluated results as rows, without running the checks again."""
        return spark.createDataFrame([vars(r) for r in self.results], CHECK_SCHEMA)

    @property
    def passed_count(self) -> int:
        return sum(r.passed for r in self.results)

    @property
    def failed(self) -> list[CheckResult]:
        return [r for r in self.results if not r.passed and r.severity == ERROR]

    @property
    def failed_count(self) -> int:
        return len(self.failed)

    @property
    def all_passed(self) -> bool:
        return not self.failed

    def summary(self) -> str:
        counts = f"{self.name}: {len(self.results)} checks, {self.passed_count} passed, {self.failed_count} failed"
        return "\n".join([counts, *(f"  {result}" for result in self.failed)])

    def raise_if_failed(self) -> None:
        if not self.all_passed:
            raise ValueError(f"{self.failed_count} quality checks failed\n{self.summary()}")


def check_frames(
    scan: DataFrame,
    outlet: DataFrame,
    product: DataFrame,
    promo: DataFrame,
    everyone: DataFrame,
    valid: DataFrame | None,
    promos: DataFrame,
    windows: DataFrame,
    tagged: DataFrame,
    metrics: DataFrame,
    settings: Settings,
    expected_keys: tuple[int, int] | None = None,
    totals: DataFrame | None = None,
    coverage: bool = False,
    lift_severity: str = ERROR,
    ledger: DataFrame | None = None,
    derived: bool = True,
) -> list[DataFrame]:
    """Check rows of all layers, each large input read once.

    The scan is read for the source and the discount layer together. Without ``valid`` the loyalty layer takes its
    valid lines out of ``everyone``, and with ``coverage`` measures that layer in the same pass. ``totals`` and ``ledger``
    are those of the tagged rows, stored with their rollup. Loyalty lines of an earlier run are not ``derived`` here.
    """
    if valid is None:
        among = (windows, settings, settings.broadcast_rows) if coverage else ()
        loyalty = [layers.check_loyalty_lines(everyone, *among)]
    else:
        loyalty = [layers.check_loyalty_derivation(everyone, valid, derived)]
        if coverage:
            loyalty.append(layers.check_source_coverage(valid, windows, settings, broadcast_rows=settings.broadcast_rows))
    return [
        layers.check_scan(scan, outlet, product, promo, settings, expected_keys),
        *loyalty,
        layers.check_promo_windows(promos),
        layers.check_overlap_detection(promos, windows),
        layers.check_tagged_transactions(tagged),
        layers.check_final_metrics(metrics, lift_severity),
        layers.check_reconciliation(tagged, metrics, totals, ledger),
    ]


def evaluate(frames: Sequence[DataFrame], raise_on_failure: bool = True) -> dict[str, QualityReport]:
    """Run all check frames as one job and hand each layer its results."""
    everything = QualityReport("all layers", *frames)
    reports: dict[str, QualityReport] = {}
    for layer in dict.fromkeys(r.layer for r in everything.results):
        reports[layer] = QualityReport(layer, everything.frame.filter(F.col("layer") == layer))
        reports[layer]._results = [r for r in everything.results if r.layer == layer]
    if raise_on_failure:
        everything.raise_if_failed()
    return reports


def run_all_quality_checks(
    *frames: DataFrame,
    settings: Settings,
    raise_on_failure: bool = True,
    expected_keys: tuple[int, int] | None = None,
) -> dict[str, QualityReport]:
    """Every layer's checks over the ten frames of :func:`check_frames`, in one job.

    Raises ``ValueError`` if a check of severity ``error`` fails, unless told not to.
    """
    return evaluate(check_frames(*frames, settings=settings, expected_keys=expected_keys), raise_on_failure)


def save_audit(checks: DataFrame, table_name: str) -> None:
    """Append check rows to a table that keeps those of every run."""
    checks.write.mode("append").saveAsTable(table_name)
