"""Packing token runs into windows: shallow combinations of lengths, weighted by non-negative least squares."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promolens.llm.bpe import parse_ranks
from promolens.llm.common import map_rows, numbered, parts_of, stored

#: Tokens of a sequence, bins of piece lengths, and the most pieces of an enumerated combination.
WINDOW, BINS, DEPTH = 2048, 128, 3
#: Bytes of text or ids a Python worker takes at a time, and of a row group of the stored pieces.
PART, BLOCK = 2 << 20, 16 << 20


def combinations(bins: int = BINS, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All non-increasing tuples of at most ``depth`` bin numbers that sum to ``bins``, the full window."""

    def parts(rest: int, most: int, left: int) -> Iterator[tuple[int, ...]]:
        if rest == 0:
            yield ()
        elif left:
            for first in range(min(rest, most), 0, -1):
                for others in parts(rest - first, first, left - 1):
                    yield (first, *others)

    return list(parts(bins, bins, depth))


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """Minimise ``|a x - b|`` over ``x >= 0`` by active sets: free the best column, solve, step back to what stays positive."""
    x = np.zeros(a.shape[1])
    free = np.zeros(a.shape[1], dtype=bool)
    tolerance = 1e-10 * max(1.0, float(np.abs(b).max(initial=0.0)))
    for _ in range(rounds):
        gain = np.where(free, -np.inf, a.T @ (b - a @ x))
        best = int(gain.argmax())
        if gain[best] <= tolerance:
            break
        free[best] = True
        while free.any():
            solved = np.zeros_like(x)
            solved[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            bad = free & (solved <= 0)
            if not bad.any():
                x = solved
                break
            step = (x[bad] / np.maximum(x[bad] - solved[bad], 1e-300)).min()
            x = np.where(free, x + step * (solved - x), 0.0)
            free &= x > 1e-12
            x[~free] = 0.0
    return x


def plan(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of bins with repeat counts that use up the histogram exactly.

    ``counts[k]`` is the number of pieces in bin k + 1. The least-squares weights of the exact combinations are
    rounded and cut to what is there; the rest is packed greedily, longest first, each pattern repeated as often
    as its bins allow. The work depends on the number of bins only, not on the number of pieces.
    """
    left = counts.astype(np.int64).copy()
    bins = len(left)
    patterns = combinations(bins)
    matrix = np.zeros((bins, len(patterns)))
    for k, pattern in enumerate(patterns):
        for size in pattern:
            matrix[size - 1, k] += 1
    found: list[tuple[tuple[int, ...], int]] = []
    if total := int(left.sum()):
        weights = nonnegative_least_squares(matrix, left / total) * total
        for k in np.argsort(-weights, kind="stable"):
            need = matrix[:, k].astype(np.int64)
            times = min(int(round(weights[k])), *(int(left[s - 1] // need[s - 1]) for s in patterns[k]))
            if times > 0:
                found.append((patterns[k], times))
                left -= need * times
    while left.any():
        pattern: list[int] = []
        used = np.zeros(bins, dtype=np.int64)
        room = bins
        while room and (fits := np.flatnonzero(left[:room] > used[:room])).size:
            size = int(fits[-1]) + 1
            pattern.append(size)
            used[size - 1] += 1
            room -= size
        times = int((left[used > 0] // used[used > 0]).min())
        found.append((tuple(pattern), times))
        left -= used * times
    return found


def segments(found: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """For each place in each pattern: bin, first and last number of the pieces that fill it, first sequence, place."""
    rows = []
    sequence = 0
    taken: dict[int, int] = {}
    for pattern, times in found:
        for place, size in enumerate(pattern):
            begin = taken.get(size, 0)
            taken[size] = begin + times
            rows.append((size, begin, begin + times - 1, sequence, place))
        sequence += times
    return rows


@lru_cache(maxsize=2)
def _encoding(content: bytes, pattern: str) -> tuple[tiktoken.Encoding, str]:
    """The coder, and the type of its ids: 2 bytes where the vocabulary allows it, else 4."""
    ranks = parse_ranks(content)
    encoding = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return encoding, "<u2" if max(ranks.values()) < 1 << 16 else "<u4"


def token_pieces(docs: DataFrame, content: bytes, pattern: str, end_id: int, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenise every whole text, append the end id, and cut full windows off; one row per piece.

    ``ids`` are the piece's ids as bytes, little-endian, of 2 bytes each where the vocabulary allows it, else 4. A null
    text counts as empty: only the end id. The ranks and the pattern must be the vocabulary's.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(content)

    def make() -> Callable:
        encoding, kind = _encoding(vocabulary.value, pattern)
        narrow = kind if end_id < 1 << 16 else "<u4"

        def work(keys: list, texts: list) -> list[list]:
            out: list[list] = [[], [], [], [], [], []]
            for name, value in zip(keys, texts, strict=True):
                ids = np.array([*encoding.encode_ordinary(value), end_id], dtype="<u4")
                for start in range(0, len(ids), window):
                    part = ids[start : start + window]
                    for column, x in zip(out, (name, start, len(part), zlib.crc32(part.tobytes()), len(ids), part.astype(narrow).tobytes()), strict=True):
                        column.append(x)
            return out

        return work

    schema = f"`{key}` long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
    return map_rows(docs.select(F.col(key).cast("long"), F.coalesce(F.col(text), F.lit(""))), schema, make, most=PART)


def pack(pieces: DataFrame, key: str = "doc_id", window: int = WINDOW, bins: int = BINS) -> DataFrame:
    """Give each piece (of at most ``window`` tokens) a sequence_id and an offset there.

    ``pieces`` is read twice, so it should be stored. Only the histogram of ``bins`` lengths reaches the driver;
    the plan it yields is a few thousand rows at most, whatever the number of pieces. Repeated rows are pieces of
    their own; null keys are packed like others; no rows give no rows.
    """
    spark: SparkSession = pieces.sparkSession
    unit = window // bins
    sized = pieces.withColumn("_bin", F.ceil(F.col("length") / unit).cast("int"))
    counts = np.zeros(bins, dtype=np.int64)
    for row in sized.groupBy("_bin").count().collect():
        counts[row["_bin"] - 1] = row["count"]
    places = spark.createDataFrame(segments(plan(counts)), "_in int, _from long, _to long, _sequence long, _place int")
    ranked = numbered(sized, ["_bin"], [key, "start", "ids_crc32", "length"], "_number")
    fits = (F.col("_bin") == F.col("_in")) & F.col("_number").between(F.col("_from"), F.col("_to"))
    seated = ranked.join(F.broadcast(places), fits).withColumn("sequence_id", F.col("_sequence") + F.col("_number") - F.col("_from"))
    before = Window.partitionBy("sequence_id").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    placed = seated.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    return placed.select(*pieces.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, content: bytes, pattern: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenise, cut and pack whole documents; see ``token_pieces`` and ``pack``. Each piece has its ``ids``, as an array.

    The pieces are stored in between. Places are found without the ids, which are joined to them once, by the piece.
    Null texts are the end id alone, null keys and repeated rows are packed like others, no rows give no rows; further
    columns of the documents are left behind.
    """
    return _seated(docs, content, pattern, end_id, key, text, digest=False)


def packed_digests(docs: DataFrame, content: bytes, pattern: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``pack_documents`` with the CRC-32 of the packed ids, of 4 bytes each, in place of the ids; read in one pass."""
    return _seated(docs, content, pattern, end_id, key, text, digest=True)


def _seated(docs: DataFrame, content: bytes, pattern: str, end_id: int, key: str, text: str, digest: bool) -> DataFrame:
    pieces = stored(token_pieces(docs, content, pattern, end_id, key=key, text=text).withColumn("_piece", F.monotonically_increasing_id()), block=BLOCK)
    places = pack(pieces.drop("ids"), key)
    joined = places.join(pieces.select("_piece", "ids"), "_piece")
    plain = [c for c in places.columns if c != "_piece"]
    at = plain.index("ids_crc32")
    schema = joined.select(*plain, *([] if digest else [F.array(F.lit(0)).alias("ids")])).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(batch, PART):
                columns, packed = part.columns[:-1], part.column(len(plain)).to_pylist()
                lengths = part.column(plain.index("length")).to_numpy()
                kinds = [f"<u{len(ids) // int(n)}" for ids, n in zip(packed, lengths, strict=True)]
                if digest:
                    sums = [zlib.crc32(np.frombuffer(ids, dtype=kind).astype("<u4").tobytes()) for ids, kind in zip(packed, kinds, strict=True)]
                    columns[at] = pa.array(sums, pa.int64())
                    yield pa.RecordBatch.from_arrays(columns, plain)
                else:
                    ends = np.append(0, np.cumsum(lengths)).astype(np.int32)
                    values = np.frombuffer(b"".join(packed), dtype=kinds[0]) if kinds else np.empty(0)
                    yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))], [*plain, "ids"])

    return joined.select(*plain, "ids").mapInArrow(run, schema)


def digests(packed: DataFrame) -> DataFrame:
    """Packed pieces with the CRC-32 of their ids, of 4 bytes each, in place of the ids."""
    kept = packed.drop("ids")
    names, schema = kept.columns, kept.schema
    at = names.index("ids_crc32")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, ids = batch.columns
            ends, values = ids.offsets.to_numpy().tolist(), ids.values.to_numpy()
            columns[at] = pa.array([zlib.crc32(values[a:b].astype("<u4").tobytes()) for a, b in zip(ends, ends[1:], strict=False)], pa.int64())
            yield pa.RecordBatch.from_arrays(columns, names)

    return packed.select(*names, "ids").mapInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The training sequences: one row (sequence_id, ids) for each, of at most a window of ids; none for no pieces."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
