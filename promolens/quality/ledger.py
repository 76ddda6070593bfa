"""Reconciling metrics with the ledger of the transactions they were made from, down to the place that differs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from promolens.schemas import PERIODS, PLACE_KEYS

#: Nodes of the tree's middle level.
BUCKETS = 1024
SIDES = ("source_volume", "output_volume", "source_value", "output_value")


def _entries(ledger: DataFrame, metrics: DataFrame) -> DataFrame:
    """Both sides' sums per place and period, each row with zeros for the other side, so that any level is one sum."""
    none = F.lit(0)
    source = ledger.select(*PLACE_KEYS, "period", F.coalesce("MetricVolume", none).alias(SIDES[0]), none.alias(SIDES[1]), F.coalesce("MetricValue", none).alias(SIDES[2]), none.alias(SIDES[3]))
    cells = ", ".join(f"named_struct('period', '{p}', 'volume', {p}_total_volume, 'amount', {p}_total_value)" for p in PERIODS)
    output = metrics.selectExpr(*PLACE_KEYS, f"inline(array({cells}))")
    output = output.groupBy(*PLACE_KEYS, "period").agg(F.sum("volume").alias("volume"), F.sum("amount").alias("amount"))
    output = output.select(*PLACE_KEYS, "period", none.alias(SIDES[0]), F.coalesce("volume", none).alias(SIDES[1]), none.alias(SIDES[2]), F.coalesce("amount", none).alias(SIDES[3]))
    return source.unionByName(output).withColumns({"bucket": F.pmod(F.xxhash64(*PLACE_KEYS), F.lit(BUCKETS)).cast("int")})


def _differs(df: DataFrame) -> Column:
    """Exact for decimals and integers; sums of other numbers depend on their order, so these may differ a little."""

    def pair(a: str, b: str) -> Column:
        if all(isinstance(df.schema[c].dataType, DecimalType | IntegralType) for c in (a, b)):
            return F.col(a) != F.col(b)
        return F.abs(F.col(a) - F.col(b)) > 1e-9 * F.greatest(F.abs(a), F.abs(b), F.lit(1.0))

    return pair(*SIDES[:2]) | pair(*SIDES[2:])


def _differing(entries: DataFrame, *keys: str) -> DataFrame:
    sums = entries.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in SIDES))
    return sums.filter(_differs(sums))


def differences(ledger: DataFrame, metrics: DataFrame) -> DataFrame:
    """The places and periods whose volume or value differs between the ledger and the metrics.

    Two levels of a tree: sums per bucket of places first, then per place within the few buckets that differ, so a sound
    run never goes below a thousand sums. A place that one side lacks counts there as zero. Reads both inputs twice, and
    the ledger has one row per place and period.
    """
    entries = _entries(ledger, metrics)
    buckets = _differing(entries, "bucket", "period").select("bucket", "period")  # at most BUCKETS times the periods
    suspects = entries.join(F.broadcast(buckets), ["bucket", "period"], "left_semi")
    return _differing(suspects, *PLACE_KEYS, "period")
