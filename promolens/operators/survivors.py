"""Reference tables that hold a key several times: one row of each key goes on, and what the others said is reported."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _others(df: DataFrame, keys: Sequence[str]) -> list[str]:
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"no such key columns: {missing}")
    return [c for c in df.columns if c not in keys]


def one_per_key(df: DataFrame, keys: Sequence[str], prefer: Sequence[Column] = ()) -> DataFrame:
    """One row of each key, all of it from the same input row.

    That which is first by ``prefer`` survives, smallest first and nulls before values; ties go to the smallest of the
    other columns, in their order, so the choice does not hang on the order of the rows. The aggregate is combined
    before the shuffle, so a key with very many rows is no burden. Null keys are one key. Columns must be orderable.
    """
    others = _others(df, keys)
    if not others:
        return df.distinct()
    rank = F.struct(*(c.alias(f"p{k}") for k, c in enumerate(prefer)), F.struct(*others).alias("row"))
    best = df.groupBy(*keys).agg(F.min(rank).alias("best"))
    return best.select(*keys, "best.row.*").select(*df.columns)


def key_conflicts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys whose rows do not agree: ``key_rows`` and, comma-joined in the table's order, ``differing`` columns.

    A column differs if it has two values, or a value and a null. Rows that are repeated whole are no conflict. Everything is a
    minimum, maximum or count, so nothing grows with a key's rows.
    """
    others = _others(df, keys)
    found = df.groupBy(*keys).agg(
        F.count("*").alias("key_rows"),
        *(((F.min(c) < F.max(c)) | F.count(c).between(1, F.count("*") - 1)).alias(f"_{k}") for k, c in enumerate(others)),
    )
    named = F.concat_ws(",", *(F.when(F.col(f"_{k}"), F.lit(c)) for k, c in enumerate(others)))
    return found.select(*keys, "key_rows", named.alias("differing")).filter("differing <> ''")
