"""What several of the operators share: reading, storing, numbering, word splitting in bytes."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a numbered group are dealt to this many buckets, so that no task orders a whole group.
BUCKETS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per session, in case it is not installed where they run."""
    context = spark.sparkContext
    if not hasattr(context, "_shipped_package"):
        package = Path(__file__).resolve().parents[1]
        path = f"{tempfile.mkdtemp(prefix='package-')}/{package.name}.zip"
        with zipfile.ZipFile(path, "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        context.addPyFile(path)
        context._shipped_package = True


def checkpoint_folder(spark: SparkSession) -> str:
    """A new folder in the shared one the session names in ``spark.checkpoint.dir``, else in the warehouse.

    A path on the machine's own disk is refused unless the session is local.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"
    if shared.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{shared} is on one machine; set spark.checkpoint.dir to a folder all executors share")
    return f"{shared.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, block: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and carry on from the files: cuts lineage, survives lost executors.

    ``block`` is the size of a row group, which a writing task holds in memory.
    """
    path = checkpoint_folder(df.sparkSession)
    df.write.options(**({"parquet.block.size": block} if block else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def parts_of(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts and byte strings take ``most`` bytes, or of one row that takes more."""
    sizes = np.zeros(batch.num_rows, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy()
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[..., Sequence]], most: int = 8 << 20) -> DataFrame:
    """``mapInArrow`` over Python lists: ``make()`` is called once per task and gives a function of the
    columns of a batch, as lists, that returns the output columns in the order of ``schema``. It gets rows of at most
    ``most`` bytes at a time, or a single longer one."""
    target = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        work, arrow = make(), to_arrow_schema(target)
        for batch in batches:
            for part in parts_of(batch, most):
                out = work(*(column.to_pylist() for column in part.columns))
                arrays = [pa.array(values, type=field.type) for values, field in zip(out, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, target)


def numbered(df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps.

    Rows are dealt to buckets by a hash of the ``order`` columns; tasks order single buckets only, and
    the numbers of earlier buckets' rows are added from a table of at most groups times BUCKETS counts.
    The number of groups must be bounded, since that table is broadcast.
    """
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(BUCKETS)).cast("int"))
    cells = dealt.groupBy(*groups, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(*groups, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy(*groups, "_bucket").orderBy(*order)))
    return (
        ranked.join(F.broadcast(starts), [*groups, "_bucket"])
        .withColumn(name, F.col("_before") + F.col("_rank") - 1)
        .drop("_bucket", "_before", "_rank")
    )


def words_of(text: Column) -> Column:
    """Words between ASCII white space, as an array; none for null."""
    parts = F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+")
    return F.array_remove(parts, "")


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: An odd multiplier and its inverse modulo 2**64, for polynomial hashes of byte ranges.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16) * 5 // 4
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in bytes, of the words between ASCII white space."""
    space = np.ones(len(data) + 2, dtype=bool)
    space[1:-1] = _SPACE[np.frombuffer(data, dtype=np.uint8)]
    turns = np.flatnonzero(space[1:] != space[:-1])
    return turns[0::2], turns[1::2]


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
