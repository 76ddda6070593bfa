"""Writing results: staged intermediate tables and the metrics table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stage_folder(spark: SparkSession) -> str:
    """A new folder for one run's staged tables.

    Staged files must outlive the executors that wrote them, so the folder lies where the session says all can reach:
    in ``spark.checkpoint.dir``, or in the warehouse where that is unset. A path on the machine's own disk is refused
    unless the session is local.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"
    local = spark.sparkContext.master.startswith("local")
    if not local and shared.startswith("file:"):
        raise ValueError(f"{shared} is on one machine; set spark.checkpoint.dir to a folder all executors share")
    return f"{shared.rstrip('/')}/promolens-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a run's staged tables, once nothing reads them any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, folder: str, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` once and carry on from the files, partitioned by a column of few values if one is named.

    Later stages re-read columns they need instead of recomputing, and the file sizes give
    the optimizer true statistics to choose between a broadcast and a shuffled join.
    """
    path = f"{folder}/{name}"
    writer = df.write.mode("error")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Where a table's earlier rows are, as one of its properties.
PREVIOUS = "promolens.previous"


def save_metrics(
    metrics: DataFrame, table_name: str, path: str | None = None, check: Callable[[DataFrame], object] | None = None
) -> None:
    """Replace all rows of a table in one step, keeping every column it ever had.

    The new rows are written to a folder of their own and read back by ``check``, which raises if they are not to be
    published. Then one change in the catalog makes that folder the table's location. Until then, and whatever fails
    before, readers find the old rows; the folder of a failed attempt is removed. The old rows stay where they were, for
    readers that have begun and for :func:`restore_previous`, until the next replacement.

    A table that does not exist is created, at ``path`` if one is given. New columns are added to the table; columns it
    has and ``metrics`` lacks are written as null. Values are cast to the table's types, which raises if one does not fit.

    A partitioned table's partitions have locations of their own in the catalog, so it can't be moved in one step: there
    the rows, already computed and checked, are inserted over the old ones, of which a copy is kept and put back if that
    fails.
    """
    spark = metrics.sparkSession
    if not spark.catalog.tableExists(table_name):
        metrics.write.options(**({"path": path} if path else {})).saveAsTable(table_name)
        try:
            if check is not None:
                check(spark.table(table_name))
        except BaseException:
            spark.sql(f"DROP TABLE {table_name}")
            raise
        return
    present = spark.table(table_name).schema
    known = {name.lower() for name in present.fieldNames()}
    added = [field for field in metrics.schema if field.name.lower() not in known]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table_name} ADD COLUMNS ({columns})")
        present = spark.table(table_name).schema
    given = {name.lower() for name in metrics.columns}
    aligned = metrics.select(
        *(
            (F.col(f.name) if f.name.lower() in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in present
        )
    )
    about = _described(spark, table_name)
    folder = f"{_versions(about['Location'])}/{uuid.uuid4().hex}"
    reader = spark.read.format(about["Provider"]).schema(present)
    try:
        aligned.write.format(about["Provider"]).save(folder)
        if check is not None:
            check(reader.load(folder))
        if "# Partition Information" in about:
            _insert_over(reader.load(folder), table_name, f"{_versions(about['Location'])}/kept-{uuid.uuid4().hex}")
            remove_folder(spark, folder)
            return
        spark.sql(f"ALTER TABLE {table_name} SET TBLPROPERTIES ('{PREVIOUS}' = '{about['Location']}')")
        spark.sql(f"ALTER TABLE {table_name} SET LOCATION '{folder}'")
    except BaseException:
        remove_folder(spark, folder)
        raise
    spark.catalog.refreshTable(table_name)
    superseded = about.get(PREVIOUS)
    if superseded not in (None, about["Location"]):
        remove_folder(spark, superseded)


def restore_previous(spark: SparkSession, table_name: str) -> None:
    """Make the rows before the last replacement the table's again, in one change; the replaced ones are kept instead."""
    about = _described(spark, table_name)
    if PREVIOUS not in about:
        raise ValueError(f"{table_name} has no earlier rows")
    spark.sql(f"ALTER TABLE {table_name} SET LOCATION '{about[PREVIOUS]}'")
    spark.sql(f"ALTER TABLE {table_name} SET TBLPROPERTIES ('{PREVIOUS}' = '{about['Location']}')")
    spark.catalog.refreshTable(table_name)


def _described(spark: SparkSession, table_name: str) -> dict[str, str]:
    """What the catalog says about the table, by name, and our property of it."""
    about = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table_name}").collect()}
    properties = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table_name}").collect()}
    return about | {key: value for key, value in properties.items() if key == PREVIOUS}


def _versions(location: str) -> str:
    """The folder of a table's versions, beside its first location."""
    suffix = "_versions"
    parent = location.rstrip("/").rsplit("/", 1)[0]
    return parent if parent.endswith(suffix) else location.rstrip("/") + suffix


def _insert_over(rows: DataFrame, table_name: str, kept: str) -> None:
    spark = rows.sparkSession
    old = spark.table(table_name)
    old.write.parquet(kept)
    # An insert takes the mode from the session alone; dynamic would keep partitions that get no rows.
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "static")
    try:
        rows.write.insertInto(table_name, overwrite=True)
    except BaseException:
        spark.read.schema(old.schema).parquet(kept).write.insertInto(table_name, overwrite=True)
        raise
    finally:
        spark.conf.set(mode, before)
    remove_folder(spark, kept)


def save_loyalty_scan(valid: DataFrame, table_name: str) -> None:
    """Keep the derived loyalty lines as a table that later runs can start from."""
    valid.write.mode("overwrite").saveAsTable(table_name)
