"""Broadcasting behind a check of size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# What a hinted broadcast may take, by rows times the schema's usual width.
MAX_BYTES = 256 << 20


def is_small(df: DataFrame, max_rows: int) -> bool:
    """Whether the frame has at most ``max_rows`` rows and by estimate MAX_BYTES. Counts the rows, a job; zero skips it."""
    if not max_rows:
        return False
    width = df._jdf.schema().defaultSize()
    return df.count() <= min(max_rows, MAX_BYTES // max(1, width))


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast if the frame has at most ``max_rows`` rows and by estimate MAX_BYTES; else leave it to Spark.

    Counts the rows, a job, so it is for dimension tables and staged results. Zero skips the
    count. What is not hinted, Spark broadcasts below its own threshold or shuffles, where
    adaptive execution splits skewed partitions.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df
