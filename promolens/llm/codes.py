"""Product codes of integer vectors, their codebooks trained by rounds of exact assignment with Orchard's search."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import stored
from promolens.llm.vectors import usable

#: Label totals of at most so many rows are broadcast; more are joined by a shuffle.
FEW = 100_000
_LONG = 2**63 - 1


class Orchard:
    """Exact nearest entries of a small codebook.

    Every entry has a list of the others, nearest first. A search goes through the list of its best entry so far; an
    entry that is better makes the search jump to that entry's list, marked entries are passed over, and it stops at the
    first that is farther from the best entry than twice that one's distance: by the triangle inequality no later one can
    be nearer than, or as near as, the best. Of equally near entries the one of lower index is the better.
    """

    def __init__(self, book: np.ndarray) -> None:
        self.book = book
        n = len(book)
        self.apart = np.array([((book - entry) ** 2).sum(axis=1) for entry in book], dtype=np.int64).reshape(n, n)
        order = np.argsort(self.apart, axis=1, kind="stable")
        self.lists = order[order != np.arange(n)[:, None]].reshape(n, n - 1)
        spread = book.max(axis=0) - book.min(axis=0)
        self.axis = int(spread.argmax())
        self.along = np.argsort(book[:, self.axis], kind="stable")
        self.marks = book[self.along, self.axis]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each point's nearest entry. The search begins at an entry alike in one component."""
        rows, entries = np.arange(len(points)), len(self.book)
        best = self.along[np.minimum(np.searchsorted(self.marks, points[:, self.axis]), entries - 1)]
        least = ((points - self.book[best]) ** 2).sum(axis=1)
        marked = np.zeros((len(points), entries), dtype=bool)
        marked[rows, best] = True
        at = np.zeros(len(points), dtype=np.int64)
        live = rows if entries > 1 else rows[:0]
        while len(live):
            entry = self.lists[best[live], at[live]]
            within = self.apart[best[live], entry] <= 4 * least[live]
            live, entry = live[within], entry[within]
            at[live] += 1
            new = ~marked[live, entry]
            point, entry = live[new], entry[new]
            marked[point, entry] = True
            away = ((points[point] - self.book[entry]) ** 2).sum(axis=1)
            better = (away < least[point]) | ((away == least[point]) & (entry < best[point]))
            point = point[better]
            best[point], least[point], at[point] = entry[better], away[better], 0
            live = live[at[live] < entries - 1]
        return best, least


def matrix(rows: pa.ListArray, width: int, scale: int, bound: int) -> np.ndarray:
    """floor(scale * x) of each component, within plus and minus ``bound``; shorter vectors are filled up with zeros."""
    sizes = np.diff(rows.offsets.to_numpy())
    values = np.floor(scale * rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).clip(-bound, bound).astype(np.int64)
    if (sizes == width).all():
        return values.reshape(len(rows), width)
    out = np.zeros((len(rows), width), dtype=np.int64)
    index = np.repeat(np.arange(len(rows)), sizes)
    out[index, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


@dataclass(frozen=True)
class Compressed:
    """Rows (key, label, code, error), and the codebooks: by part, entry and component."""

    rows: DataFrame
    books: np.ndarray

    @property
    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()

    def with_label_errors(self) -> DataFrame:
        """Add ``label_error``, the error summed over rows of equal labels; rows without a label are together.

        Summed before any shuffle, so a label of most rows is one row a task. Totals beyond a long count as the largest long.
        """
        totals = self.rows.groupBy(F.col("label").alias("_label")).agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
        if self.rows.select("label").distinct().count() <= FEW:
            totals = F.broadcast(totals)
        return self.rows.join(totals, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def compress(
    vectors: DataFrame,
    scale: int = 4096,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> Compressed:
    """Train a codebook for each of ``parts`` consecutive parts, and code every vector by its nearest entries.

    Codebooks start as the parts of the vectors with the ``entries`` smallest keys. Each round assigns every part to its
    nearest entry and replaces the entries by the componentwise floor of the mean of their parts; one without parts
    stays. A code is the entries' indexes in the order of parts, two hex digits each; the error is the summed squared
    distance.

    Null vectors and those with null or non-finite components take no part. Others may have any length: they are filled
    up with zeros to the longest, and that to a multiple of ``parts``. Null keys are the last of the smallest, and of
    equal keys the smaller vector comes first; repeated rows are coded each. Fewer rows than ``entries`` make smaller
    codebooks, none make none and no rows. Integers are held within plus and minus 2**29 / sqrt(dimensions), so that no
    distance exceeds a long.

    A round is one pass: each task sums its parts by entry, and the tables of at most parts times entries sums are added
    up in Spark. Only the codebooks and the first vectors reach the driver.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits a part")
    rows = vectors.filter(usable(F.col(vector))).select(F.col(key).cast("long").alias("key"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    longest = rows.agg(F.max(F.size("v"))).first()[0]
    schema = rows.select("key", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).schema
    if longest is None:
        return Compressed(rows.sparkSession.createDataFrame([], schema), np.zeros((parts, 0, 0), dtype=np.int64))
    part = max(1, math.ceil(longest / parts))
    width = part * parts
    bound = math.isqrt((1 << 60) // width) // 2

    def cut(column: pa.Array) -> np.ndarray:
        return matrix(column, width, scale, bound).reshape(len(column), parts, part)

    first = rows.orderBy(F.col("key").asc_nulls_last(), "v").limit(entries).select("v").collect()
    books = cut(pa.array([r["v"] for r in first], type=pa.list_(pa.float64()))).transpose(1, 0, 2)
    for _ in range(rounds):
        books = _moved(books, _sums(rows.select("v"), books, cut))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Orchard(book) for book in books]
        for batch in batches:
            points = cut(batch.column(2))
            found = [search.nearest(points[:, k]) for k, search in enumerate(searches)]
            codes = np.stack([best for best, _ in found], axis=1).astype(np.uint8)
            errors = np.sum([least for _, least in found], axis=0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in codes]), pa.array(errors)], ["key", "label", "code", "error"])

    return Compressed(stored(rows.mapInArrow(encode, schema)), books)


def _sums(rows: DataFrame, books: np.ndarray, cut) -> list:
    """For each part and entry that has any: the number and the componentwise sums of the parts assigned to it."""
    parts, entries, width = books.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Orchard(book) for book in books]
        sums, counts = np.zeros((parts, entries, width), dtype=np.int64), np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            points = cut(batch.column(0))
            for k, search in enumerate(searches):
                best, _ = search.nearest(points[:, k])
                np.add.at(sums[k], best, points[:, k])
                counts[k] += np.bincount(best, minlength=entries)
        k, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[k, e]), pa.array(list(sums[k, e]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    tables = rows.mapInArrow(run, "part int, entry int, n long, sums array<long>")
    total = [F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(width)]
    return tables.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total).collect()


def _moved(books: np.ndarray, sums: list) -> np.ndarray:
    out = books.copy()
    for row in sums:
        out[row["part"], row["entry"]] = [int(row[f"s{d}"]) // row["n"] for d in range(books.shape[2])]
    return out
