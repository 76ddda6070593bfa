"""Checks as data: measures are aggregated in one pass, then each check reads the one row of them.

Measures and conditions are SQL expressions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERROR, WARN, INFO = "error", "warn", "info"


@dataclass(frozen=True)
class Check:
    """A named condition over measures. ``passed`` that comes out null counts as failed.

    ``detail`` is an expression whose text, if any, ends the message of a check that has not passed.
    """

    name: str
    label: str
    value: str
    passed: str
    threshold: str = "0"
    severity: str = ERROR
    unit: str = ""
    detail: str = "''"


def none_of(name: str, label: str, measure: str, severity: str = ERROR) -> Check:
    """Passes if the measure, a count of offending rows, is zero."""
    return Check(name, label, measure, f"{measure} = 0", severity=severity)


def some_of(name: str, label: str, measure: str) -> Check:
    """Passes if the measure is above zero."""
    return Check(name, label, measure, f"{measure} > 0")


def columns_present(name: str, df: DataFrame, columns: Iterable[str]) -> Check:
    """Passes if the frame has the columns. Needs no data."""
    missing = [c for c in columns if c not in df.columns]
    label = "Missing columns " + ", ".join(missing) if missing else "Missing columns"
    return Check(name, label, str(len(missing)), str(not missing))


def column(df: DataFrame, name: str) -> str:
    """The column, or null where the frame lacks it."""
    return name if name in df.columns else "NULL"


def over(df: DataFrame, aggregate: str, *columns: str) -> str:
    """The aggregate, or null where the frame lacks one of its columns; a check of null fails."""
    return aggregate if all(c in df.columns for c in columns) else "max(CAST(NULL AS BIGINT))"


def literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def literals(texts: Iterable[str]) -> str:
    return ", ".join(map(literal, texts))


def percent(part: str, whole: str) -> str:
    """``part`` of ``whole`` in percent, null where ``whole`` is zero."""
    return f"try_divide(CAST({part} AS DOUBLE), CAST({whole} AS DOUBLE)) * 100"


def measure(df: DataFrame, measures: Mapping[str, str]) -> DataFrame:
    """One row with a column per aggregate."""
    return df.selectExpr(*(f"{sql} AS {name}" for name, sql in measures.items()))


def side_by_side(*frames: DataFrame) -> DataFrame:
    """One row of all columns from one-row frames with different columns."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*(F.max(name).alias(name) for name in stacked.columns))


def as_checks(layer: str, measures: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """One row per check: layer, check_name, severity, passed, message, value, threshold, ts."""
    return as_layers(measures, {layer: checks})


def as_layers(measures: DataFrame, layers: Mapping[str, Iterable[Check]]) -> DataFrame:
    """Like :func:`as_checks` for several layers that share one row of measures, and so one pass over the data."""

    def row(layer: str, check: Check) -> str:
        return f"""named_struct(
            'layer', {literal(layer)}, 'check_name', {literal(check.name)},
            'severity', {literal(check.severity)}, 'passed', coalesce({check.passed}, false),
            'message', concat({literal(check.label + ": ")},
                coalesce(CAST({check.value} AS STRING), 'unknown'), {literal(check.unit)},
                CASE WHEN {check.passed} THEN '' ELSE coalesce({check.detail}, '') END),
            'value', CAST({check.value} AS DOUBLE), 'threshold', CAST({check.threshold} AS DOUBLE))"""

    rows = ", ".join(row(layer, check) for layer, checks in layers.items() for check in checks)
    return measures.selectExpr(f"inline(array({rows}))", "current_timestamp() AS ts")
