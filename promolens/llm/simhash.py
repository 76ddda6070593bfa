"""SimHash near-duplicates by anchor-point covering, and the components that their links make."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import fresh, map_rows, stored

#: Fingerprints link at this many differing bits; each half of 32 bits is covered for half as many.
DISTANCE = 3
#: An anchor with more rows than this is split into blocks of its homes.
HOT = 50_000
_BITS = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.int64)


def fingerprint(text: str | None, words: int = 3) -> int:
    """A bit is one if set in over half of the hashes (XXH64, seed 42) of the text's word shingles, repeats included.

    A-Z count as a-z; a text of fewer words is one shingle; without words the fingerprint is 0. Signed 64 bits.
    """
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    last = ends[min(words, len(parts)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, last, strict=False)], dtype="<u8")
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(lanes[:, k], minlength=256) @ _BITS for k in range(8)])
    packed = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and the fingerprint of every whole text."""

    def make() -> Callable:
        return lambda keys, texts: [keys, [fingerprint(value, words) for value in texts]]

    return map_rows(docs.select(F.col(key).cast("long"), F.col(text)), "key long, fp long", make)


def _pairs() -> np.ndarray:
    """For each syndrome of the Hamming code of length 31: the 15 two-bit flips that have it."""
    flips = np.zeros((32, 15), dtype=np.uint32)
    for syndrome in range(1, 32):
        both = [(i, i ^ syndrome) for i in range(1, 32) if i < i ^ syndrome]
        flips[syndrome] = [1 << (i - 1) | 1 << (j - 1) for i, j in both]
    return flips


_PAIRS = _pairs()
_CHECKS = np.array([sum(1 << (i - 1) for i in range(1, 32) if i >> k & 1) for k in range(5)], dtype=np.uint32)
_CODED = np.uint32((1 << 31) - 1)


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of 32-bit values: the value's index, the anchor, and whether it is the value's home.

    The anchors are the words of the perfect Hamming code of length 31 and covering radius 1, times one free bit.
    Every value's home is within 1; returned are all anchors within 2, so that two values that differ in at most
    one bit meet at each other's home.
    """
    coded, free = half & _CODED, half & ~_CODED
    syndrome = np.zeros(len(half), dtype=np.uint32)
    for k in range(5):
        syndrome |= (np.bitwise_count(coded & _CHECKS[k]).astype(np.uint32) & np.uint32(1)) << np.uint32(k)
    off = syndrome > 0
    home = np.where(off, coded ^ (np.uint32(1) << (np.maximum(syndrome, 1) - np.uint32(1))), coded)
    index = np.arange(len(half))
    far = index[off]
    others = (coded[off, None] ^ _PAIRS[syndrome[off]]) | free[off, None]
    return (
        np.concatenate([index, index, np.repeat(far, 15)]),
        np.concatenate([home | free, home | (free ^ ~_CODED), others.ravel()]),
        np.concatenate([np.ones(len(half), bool), np.zeros(len(half) + 15 * len(far), bool)]),
    )


def anchored(distinct: DataFrame) -> DataFrame:
    """Each fingerprint at all its anchors, for both halves: of two that differ in 3 bits, one half differs in 1 at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 10_000):
                fp = batch.column(0).to_numpy()[at : at + 10_000]
                for side in (0, 1):
                    index, anchor, home = anchors((fp.view(np.uint64) >> np.uint64(32 * side)).astype(np.uint32))
                    place = anchor.astype(np.int64) + (side << 32)
                    yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(fp[index]), pa.array(home)], ["anchor", "fp", "home"])

    return distinct.select("fp").mapInArrow(run, "anchor long, fp long, home boolean")


def _forest(pairs: np.ndarray) -> np.ndarray:
    """Links that connect what the given pairs connect, without cycles: rows of two, as given."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for x, y in pairs.tolist():
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            kept.append((x, y))
    return np.array(kept, dtype=np.int64).reshape(-1, 2)


def compare(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Links between a home and another fingerprint of the same anchor, for rows sorted by anchor."""
    begins = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    sizes = np.diff(np.append(begins, len(anchor)))
    links: list[tuple[int, int]] = []
    small = np.repeat(sizes <= 32, sizes)
    live = np.flatnonzero(small[:-1]) if len(anchor) > 1 else np.empty(0, np.int64)
    for step in range(1, int(sizes[sizes <= 32].max(initial=1))):
        live = live[live + step < len(anchor)]
        live = live[anchor[live] == anchor[live + step]]
        other = live + step
        near = (np.bitwise_count((fp[live] ^ fp[other]).view(np.uint64)) <= distance) & (home[live] | home[other])
        links += zip(fp[live[near]].tolist(), fp[other[near]].tolist(), strict=True)
    for k in np.flatnonzero(sizes > 32):
        group = slice(begins[k], begins[k] + sizes[k])
        own, homes = fp[group], fp[group][home[group]]
        width = max(1, (1 << 20) // len(own))
        # Whole numbers throughout: a fingerprint does not fit into a float.
        held = np.empty((0, 2), dtype=np.int64)
        for at in range(0, len(homes), width):
            block = homes[at : at + width]
            i, j = np.nonzero(np.bitwise_count((block[:, None] ^ own[None, :]).view(np.uint64)) <= distance)
            apart = block[i] != own[j]
            held = _forest(np.concatenate([held, np.stack([block[i[apart]], own[j[apart]]], axis=1)]))
        links += map(tuple, held.tolist())
    return links


def spread(places: DataFrame, node: str, hot: int) -> DataFrame:
    """Add ``block``: 0, or for anchors of more than ``hot`` rows one of several, each with all rows and a part of the homes."""
    crowded = places.groupBy("anchor").count().filter(F.col("count") > hot)
    counted = places.join(crowded, "anchor", "left").withColumn("blocks", F.coalesce(F.ceil(F.col("count") / hot).cast("int"), F.lit(1)))
    own = F.pmod(F.xxhash64(node), F.col("blocks"))
    every = counted.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("blocks") - 1).cast("long"))))
    return every.withColumn("home", F.col("home") & (own == F.col("block")))


def grouped(columns: int, solve: Callable[[list[np.ndarray]], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Call ``solve`` with rows, ordered by their first two columns, such that no group of those two is parted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(columns)]
            held = [np.concatenate(pair) for pair in zip(held, new, strict=True)] if held else new
            change = np.flatnonzero((held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1]))
            if len(change):
                cut = change[-1] + 1
                yield solve([column[:cut] for column in held])
                held = [column[cut:] for column in held]
        if held and len(held[0]):
            yield solve(held)

    return run


def places_of(columns: list[np.ndarray]) -> np.ndarray:
    """Consecutive numbers for the groups of the first two columns."""
    return np.cumsum(np.concatenate(([0], (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1]))))


def pairs_record(found: set[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])


def links(distinct: DataFrame, hot: int = HOT) -> DataFrame:
    """Pairs (a > b) of different fingerprints that connect all that are within DISTANCE; one row a pair.

    Per anchor, spanning links stand for all pairs. An anchor of more than ``hot`` rows is split: its homes are
    dealt to blocks, and each block gets all its rows to compare with.
    """
    dealt = spread(anchored(distinct), "fp", hot)

    def solve(columns: list[np.ndarray]) -> pa.RecordBatch:
        found = compare(places_of(columns), columns[2], columns[3])
        return pairs_record({(max(x, y), min(x, y)) for x, y in found})

    ordered = dealt.select("anchor", "block", "fp", "home").repartition("anchor", "block").sortWithinPartitions("anchor", "block")
    return ordered.mapInArrow(grouped(4, solve), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """The smallest member of each node's component, for pairs (a > b): rows (node, root).

    Alternates two steps until nothing changes: every node's larger neighbours are linked to its smallest one, then
    its smaller neighbours are. Each round is written to the shared folder. A node with very many neighbours is a
    skewed join key, not a group that one task must hold.
    """
    edges = stored(edges.select("a", "b"))
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.union(least.select("a", F.col("m").alias("b"))).distinct())
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def near_duplicates(docs: DataFrame, words: int = 3, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """The key, the signed fingerprint ``fp`` and ``component_id``, the smallest key reachable over links, of every row.

    Fingerprints link at DISTANCE or fewer differing bits; equal ones are one class from the start, so copies cost
    one row each and are never paired. Null texts have fingerprint 0 and link like others. Repeated rows stay rows
    of their own. Null keys take part; they are the component's id only if it has no other key.
    """
    prints = stored(fingerprints(docs, words, key, text))
    distinct = prints.groupBy("fp").agg(F.min("key").alias("first"))
    joined = components(links(distinct, hot))
    labelled = distinct.join(joined, distinct["fp"] == joined["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = labelled.join(smallest, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(F.col("key").alias(key), "fp", "component_id")


def one_of_each_group(docs: DataFrame, words: int = 3, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """The rows of ``docs`` that stand for their component of ``near_duplicates``, with all their columns: one row each.

    It is the row of the smallest key; null keys come last, and of equal keys the smaller fingerprint and then the
    smaller hash of the text decide. Null texts and those without words are one group. Of repeated rows one stays. No
    rows give none. ``docs`` is read twice, and only keys and hashes are compared.
    """

    def make() -> Callable:
        return lambda keys, hashes, texts: [keys, hashes, [fingerprint(value, words) for value in texts]]

    given = docs.select(F.col(key).cast("long"), F.xxhash64(text), F.col(text))
    prints = stored(map_rows(given, "key long, text_hash long, fp long", make, most=4 << 20))
    first = F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "fp", "text_hash")).alias("first")
    distinct = prints.groupBy("fp").agg(first)
    joined = components(links(distinct, hot))
    labelled = distinct.join(joined, distinct["fp"] == joined["node"], "left").select(F.coalesce("root", "fp").alias("root"), "first")
    name, content = fresh(docs, "kept_key"), fresh(docs, "kept_hash")
    kept = labelled.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.key").alias(name), F.col("first.text_hash").alias(content))
    own = F.col(key).cast("long").eqNullSafe(F.col(name)) & (F.xxhash64(text) == F.col(content))
    return docs.join(kept, own).dropDuplicates([name, content]).select(*docs.columns)
