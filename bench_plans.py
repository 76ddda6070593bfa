"""Compare plan shapes on stored inputs: prints one JSON line a comparison.

``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_RUNS`` as for ``bench.py``. Overlap flags by running extremes and by pairs,
on the sample's promotions and with every promotion of the sample at a tenth of its places; tagging in one pass,
broadcast and shuffled, and as three joins and a union.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.operators.overlap import add_overlap_flags
from promolens.operators.tagging import (
    tag_after_transactions,
    tag_before_transactions,
    tag_during_transactions,
    tag_transactions,
    union_all_periods,
)
from promolens.plans.stages import Stages
from promolens.schemas import BRAND, END, OUTLET, PROMO, START
from promolens.sources.sample import SETTINGS, sample_catalog
from promolens.sources.sink import remove_folder, stage


def by_pairs(promos: DataFrame) -> DataFrame:
    """Flags from a self join of the promotions of an outlet and brand, for comparison only."""
    other = promos.select(*(F.col(c).alias(f"o_{c}") for c in (OUTLET, BRAND, PROMO, START, END)))
    same_place = (F.col(OUTLET) == F.col(f"o_{OUTLET}")) & (F.col(BRAND) == F.col(f"o_{BRAND}"))
    pairs = promos.join(other, same_place & (F.col(PROMO) != F.col(f"o_{PROMO}")), "left")
    meets = lambda first, last: ((F.col(f"o_{START}") <= F.col(last)) & (F.col(f"o_{END}") >= F.col(first))).cast("int")
    return pairs.groupBy(OUTLET, BRAND, PROMO).agg(
        F.max(meets("before_candidate_start", "before_candidate_end")).alias("before_overlap"),
        F.max(meets("after_candidate_start", "after_candidate_end")).alias("after_overlap"),
    )


def seconds(make: Callable[[], DataFrame], runs: int) -> float:
    times = []
    for _ in range(runs + 1):
        begun = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - begun)
    return round(statistics.median(times[1:]), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("promolens-plans").config("spark.sql.shuffle.partitions", cpus)
    spark = builder.config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    stages = Stages(sample_catalog(spark, folder), SETTINGS)
    promos, windows = stages.kept("promos"), stages.kept("windows")
    loyalty = stages.kept("loyalty_valid")
    number = F.pmod(F.xxhash64(OUTLET, BRAND), F.lit(10))
    moved = promos.withColumns({PROMO: F.concat_ws("|", OUTLET, BRAND, PROMO), OUTLET: F.lit("one"), BRAND: number.cast("string")})
    crowded = stage(moved, stages.folder, "crowded")

    def tagged(rows: int) -> DataFrame:
        return tag_transactions(loyalty, windows, SETTINGS, broadcast_rows=rows)

    def three() -> DataFrame:
        taggers = (tag_during_transactions, tag_before_transactions, tag_after_transactions)
        return union_all_periods(*(t(loyalty, windows, SETTINGS, broadcast_rows=10_000_000) for t in taggers))

    threshold = "spark.sql.autoBroadcastJoinThreshold"
    cases: dict[str, tuple[Callable[[], DataFrame], bool]] = {
        "overlap, running extremes": (lambda: add_overlap_flags(promos), True),
        "overlap, pairs": (lambda: by_pairs(promos), True),
        "overlap in ten places, running extremes": (lambda: add_overlap_flags(crowded), True),
        "tagging in one pass, broadcast": (lambda: tagged(10_000_000), True),
        "tagging in one pass, shuffled": (lambda: tagged(0), False),
        "tagging by three joins, broadcast": (three, True),
    }
    if os.environ.get("BENCH_PAIRS"):  # grows with the square of a place's promotions
        cases["overlap in ten places, pairs"] = (lambda: by_pairs(crowded), True)
    sizes = {"promotions": promos.count(), "loyalty lines": loyalty.count(), "sf": os.path.basename(folder.rstrip("/"))}
    for name, (make, broadcast) in cases.items():
        for key in (threshold, "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.set(key, "10MB" if broadcast else "-1")
        print(json.dumps({"case": name, "seconds": seconds(make, runs), **sizes}), flush=True)
    remove_folder(spark, stages.folder)
    spark.stop()


if __name__ == "__main__":
    main()
