from __future__ import annotations

import sys
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from promolens.config import Settings  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("promolens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(folder / "checkpoints"))
    yield session
    session.stop()


@pytest.fixture
def settings() -> Settings:
    return Settings(
        data_start=date(2025, 1, 1), as_of=date(2026, 12, 1), brand_rules=(), broadcast_rows=0
    )


def bag(df) -> list[tuple]:
    """Rows in any order, as sorted tuples."""
    return sorted((tuple(row) for row in df.collect()), key=repr)
