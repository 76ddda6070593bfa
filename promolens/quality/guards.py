"""Checks that ride in the job that writes: rows that break one raise there, so nothing is read for them alone.

The conditions are those of ``validators``, whose functions run a job each and raise at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.quality.core import literal, literals
from promolens.quality.layers import DISCOUNT_COLUMNS
from promolens.schemas import BRAND, END, OUTLET, PERIODS, PROMO, START

# How a raised message begins, for telling it from other errors.
MARK = "check of promolens failed: "


def guarded(df: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """``df``, whose job fails at the first row for which a condition, an SQL expression, is not true.

    The message names the first broken condition. The test is no deterministic one to the optimizer, so it stays where it
    is put: it neither moves below a join, where it would see rows that are not of the result, nor away. A job that does not
    need all rows, as under a limit, tests those it reads.
    """
    broken = " ".join(f"WHEN NOT coalesce({condition}, false) THEN raise_error({literal(MARK + name)})" for name, condition in conditions.items())
    return df.filter(F.expr(f"CASE {broken} ELSE monotonically_increasing_id() >= 0 END"))


@contextmanager
def violations() -> Iterator[None]:
    """Turns a guard's failure inside the block into an ``AssertionError`` that names the check."""
    try:
        yield
    except Exception as error:
        found = re.search(f"{MARK}(\\w+)", str(error))
        if found is None:
            raise
        raise AssertionError(found[1]) from error


def guard_discount_columns(df: DataFrame) -> DataFrame:
    """A missing column raises at once. A null amount breaks no check, a null flag does."""
    missing = [c for c in DISCOUNT_COLUMNS if c not in df.columns]
    if missing:
        raise AssertionError(f"discount_columns_present: Missing columns {', '.join(missing)}")
    names = ("no_negative_smp", "no_negative_mp", "no_negative_cpn")
    amounts = {name: f"{column} IS NULL OR {column} >= 0" for name, column in zip(names, DISCOUNT_COLUMNS, strict=False)}
    return guarded(df, amounts | {"is_promo_valid": f"{DISCOUNT_COLUMNS[3]} IN (0, 1)"})


def guard_loyalty_derivation(valid: DataFrame) -> DataFrame:
    return guarded(
        valid,
        {
            "no_null_loyalty_codes": "LoyaltyCode IS NOT NULL",
            "no_empty_loyalty_codes": "LoyaltyCode <> ''",
            "codes_start_with_submitter": "coalesce(startswith(LoyaltyCode, CAST(SubmitterName AS STRING)), true)",
        },
    )


def guard_promo_windows(df: DataFrame) -> DataFrame:
    """A null date breaks the last check, as it makes no duration."""
    return guarded(
        df,
        {
            "no_negative_durations": "promo_duration_days IS NULL OR promo_duration_days > 0",
            "start_before_end": f"coalesce({START} <= {END}, true)",
            "before_window_correct": f"coalesce(before_candidate_end < {START}, true)",
            "after_window_correct": f"coalesce(after_candidate_start > {END}, true)",
            "duration_consistent": f"promo_duration_days = datediff({END}, {START}) + 1",
        },
    )


def guard_overlap_detection(promos: DataFrame, windows: DataFrame) -> DataFrame:
    """Flags and dates by row. That no promotion was lost is a comparison of two counts, made at once: of stored tables,
    which they are in a run, that reads no column."""
    if promos.count() != windows.count():
        raise AssertionError("row_count_preserved")
    conditions = {f"{side}_overlap_valid": f"{side}_overlap IN (0, 1)" for side in ("before", "after")}
    for side, rejected in (("before", "null_dates_when_invalid"), ("after", "null_after_dates_when_invalid")):
        first, last, accepted = f"{side}_window_start", f"{side}_window_end", f"coalesce(has_{side}_window, false)"
        conditions[rejected] = f"{accepted} OR {first} IS NULL AND {last} IS NULL"
        conditions[f"{side}_dates_when_valid"] = f"NOT {accepted} OR {first} IS NOT NULL AND {last} IS NOT NULL"
    return guarded(windows, conditions)


def guard_tagged_transactions(tagged: DataFrame) -> DataFrame:
    return guarded(
        tagged,
        {
            "no_null_periods": "period IS NOT NULL",
            "valid_period_values": f"period IN ({literals(PERIODS)})",
            "no_null_loyalty_codes": "LoyaltyCode IS NOT NULL",
            "no_null_outlets": f"{OUTLET} IS NOT NULL",
            "no_negative_volumes": "coalesce(MetricVolume >= 0, true)",
        },
    )


def guard_metrics(metrics: DataFrame) -> DataFrame:
    return guarded(
        metrics,
        {
            "no_null_outlets": f"{OUTLET} IS NOT NULL",
            "no_null_promos": f"{PROMO} IS NOT NULL",
            "no_null_brands": f"{BRAND} IS NOT NULL",
            "no_null_dates": f"{START} IS NOT NULL AND {END} IS NOT NULL",
            "no_negative_during_volume": "coalesce(during_promo_total_volume >= 0, true)",
        },
    )
