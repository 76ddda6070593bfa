"""Hard negatives by inner product: best-first search in STR-packed R-trees, within windows of scores."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import stored
from promolens.llm.vectors import usable

#: Vectors and anchors of a block; one task meets a block of each.
VECTOR_BLOCK, ANCHOR_BLOCK = 8192, 1024
#: Vectors of a leaf and children of a node. Reading a leaf has a fixed cost, which leaves of 128 paid more often than they spared reading.
LEAF, FAN = 512, 8
#: Integers are held within plus and minus this over the root of the dimensions, so that products are exact in doubles.
_SQUARE = 1 << 52


@dataclass
class Wanted:
    """The ``k`` best scores from ``low`` to ``high``, ties by smaller id; the best so far, in order."""

    low: float
    high: float
    k: int
    scores: np.ndarray = field(default_factory=lambda: np.empty(0))
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.int64))

    #: What a score must reach: the window's lower end, or the kth best score.
    least: float = field(init=False)

    def __post_init__(self) -> None:
        self.least = self.low

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = (scores >= self.least) & (scores <= self.high)
        if fits.any():
            scores, ids = np.concatenate([self.scores, scores[fits]]), np.concatenate([self.ids, ids[fits]])
            top = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[top], ids[top]
            if len(top) == self.k:
                self.least = float(self.scores[-1])


class Tree:
    """An R-tree packed by sort-tile-recursive: vectors are sorted by a component and cut into slabs of whole leaves,
    each slab by the next component, the widest ones first; consecutive leaves share a parent, and so on up."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, labels: np.ndarray, leaf: int = LEAF, fan: int = FAN) -> None:
        axes = np.argsort(-points.var(axis=0), kind="stable") if len(points) else np.empty(0, dtype=np.int64)
        order = np.array(self._tiles(points, np.arange(len(points)), list(axes), leaf), dtype=np.int64)
        self.points, self.ids, self.labels = points[order], ids[order], labels[order]
        starts = np.arange(0, len(points), leaf)
        low, high = np.minimum.reduceat(self.points, starts), np.maximum.reduceat(self.points, starts)
        self.leaf, self.fan, self.low, self.high = leaf, fan, [low], [high]
        while len(self.low[-1]) > 1:
            starts = np.arange(0, len(self.low[-1]), fan)
            self.low.append(np.minimum.reduceat(self.low[-1], starts))
            self.high.append(np.maximum.reduceat(self.high[-1], starts))

    @staticmethod
    def _tiles(points: np.ndarray, rows: np.ndarray, axes: list[int], leaf: int) -> list[int]:
        """The rows in the order of their leaves, each but the last full."""
        pages = math.ceil(len(rows) / leaf)
        if pages <= 1 or not axes:
            return rows.tolist()
        rows = rows[np.argsort(points[rows, axes[0]], kind="stable")]
        slabs = math.ceil(pages ** (1 / len(axes)))
        width = leaf * math.ceil(pages / slabs)
        return [row for at in range(0, len(rows), width) for row in Tree._tiles(points, rows[at : at + width], axes[1:], leaf)]

    def intervals(self, anchors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each level, least and greatest inner products of the anchors with any vector in each box: a component
        between two bounds, times the anchor's, lies between the two products."""
        plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return [(plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T) for low, high in zip(self.low, self.high, strict=True)]

    def search(self, anchor: np.ndarray, name: int, fits: np.ndarray, wanted: Sequence[Wanted], least: Sequence[Sequence[float]], most: Sequence[Sequence[float]]) -> int:
        """Fill ``wanted`` from the rows that ``fits`` and that are not the anchor's own; the number of leaves read.

        ``least`` and ``most`` are the anchor's intervals. The queue gives the box with the greatest bound first. A box
        is passed over if for every window its interval lies outside, or strictly below the kth best score.
        """
        top = len(self.low) - 1
        queue = [(-most[top][0], top, 0)] if wanted else []
        read = 0
        while queue:
            _, level, node = heapq.heappop(queue)
            open_ = [w for w in wanted if most[level][node] >= w.least and least[level][node] <= w.high]
            if not open_:
                continue
            if level:
                for child in range(self.fan * node, min(self.fan * (node + 1), len(most[level - 1]))):
                    if any(most[level - 1][child] >= w.least and least[level - 1][child] <= w.high for w in open_):
                        heapq.heappush(queue, (-most[level - 1][child], level - 1, child))
            else:
                read += 1
                rows = slice(self.leaf * node, self.leaf * (node + 1))
                scores = self.points[rows] @ anchor
                # Most leaves have nothing for any window; one comparison shows it.
                near = scores >= min(w.least for w in open_)
                if near.any():
                    ids = self.ids[rows]
                    near &= fits[rows] & (ids != name)
                    for w in open_:
                        w.take(scores[near], ids[near])
        return read


def _integers(rows: pa.ListArray, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) as doubles, filled up with zeros; held within the bound."""
    bound = math.isqrt(_SQUARE // width)
    sizes = np.diff(rows.offsets.to_numpy())
    out = np.zeros((len(rows), width))
    index = np.repeat(np.arange(len(rows)), sizes)
    out[index, np.arange(len(index)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.floor(scale * rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).clip(-bound, bound)
    return out


def _by_blocks(vectors: DataFrame, anchors: DataFrame, counts: tuple[int, int, int], scale: int, wanted_of: Callable, same_label: bool, schema: str) -> DataFrame:
    """Every block of ``vectors`` (id, label, v) searched for every block of ``anchors`` (id, label, v, windows).

    ``wanted_of(windows)`` gives an anchor's windows as (rank, Wanted); found are rows (anchor_id, window, vec_id, score).
    Rows are dealt to blocks whatever their values, so no label or repeated vector makes a block large.
    """
    n, n_asked, width = counts
    blocks, asked_blocks = max(1, math.ceil(n / VECTOR_BLOCK)), max(1, math.ceil(n_asked / ANCHOR_BLOCK))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    none = F.lit(None).cast(anchors.schema["windows"].dataType)
    deal = F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).cast("int")
    stored_side = vectors.select(deal.alias("block"), every(asked_blocks).alias("asked_block"), F.lit(False).alias("asks"), "id", "label", "v", none.alias("windows"))
    asked_side = anchors.select(every(blocks).alias("block"), F.pmod(F.xxhash64("id"), F.lit(asked_blocks)).cast("int").alias("asked_block"), F.lit(True).alias("asks"), "id", "label", "v", "windows")

    def run(group: pa.Table) -> pa.Table:
        asks = group["asks"].to_numpy()
        found: list[tuple[int, int, int, int]] = []
        if asks.any() and not asks.all():
            ids, labels = group["id"].to_numpy(), group["label"].to_numpy()
            whole = _integers(group["v"].combine_chunks(), width, scale)
            windows = group["windows"].to_pylist()
            asked, held = np.flatnonzero(asks), np.flatnonzero(~asks)
            # With a tree for each label that is asked for, an anchor meets no rows of others.
            parts = [(asked[labels[asked] == v], held[labels[held] == v]) for v in np.unique(labels[asked])] if same_label else [(asked, held)]
            for anchor_rows, rows in parts:
                if not len(rows):
                    continue
                tree = Tree(whole[rows], ids[rows], labels[rows])
                for at in range(0, len(anchor_rows), 256):
                    part = anchor_rows[at : at + 256]
                    intervals = tree.intervals(whole[part])
                    for k, row in enumerate(part):
                        wanted = wanted_of(windows[row])
                        fits = (tree.labels == labels[row]) == same_label
                        tree.search(whole[row], ids[row], fits, [w for _, w in wanted], [least[k].tolist() for least, _ in intervals], [most[k].tolist() for _, most in intervals])
                        found += [(int(ids[row]), rank, int(i), int(s)) for rank, w in wanted for i, s in zip(w.ids, w.scores, strict=True)]
        columns = list(zip(*found, strict=True)) or [[]] * 4
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())], names=["anchor_id", "window", "vec_id", "score"])

    return stored_side.union(asked_side).groupBy("block", "asked_block").applyInArrow(run, schema)


_FOUND = "anchor_id long, window int, vec_id long, score long"


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    low: tuple[int, int] = (50, 100),
    high: tuple[int, int] = (95, 100),
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
) -> DataFrame:
    """For each row that ``anchors`` selects: its best rows of the same label, and for each of these the best rows of other
    labels whose score is from ``low`` to ``high`` of the positive's, both given as fractions.

    Scores are integer inner products of floor(scale * x); higher ones come first, ties by smaller key. Returns anchor_id,
    positive_id, positive_rank, positive_score, rank, negative_id, negative_score; a positive without negatives gives none.

    Rows with a null key, label or vector, or a null or non-finite component, take no part. Shorter vectors count as
    filled up with zeros. Rows of the anchor's key are its own and neither positives nor negatives; a repeated anchor
    key is asked once, with its smallest vector (and label). Repeated rows can all be results. No rows or no anchors give
    no rows. Integers are held within plus and minus 2**26 / sqrt(dimensions): products are then exact.

    Two searches: for positives, and with their scores for negatives. Each deals vectors and anchors to blocks; a task
    packs one block of vectors into an R-tree (for positives, each label of the block's anchors into one) and asks it for one
    block of anchors, and a window keeps the best of all blocks. Its anchors are the stated set of queries against all rows.
    """
    labelled = F.col(label) if isinstance(label, str) else label
    rows = vectors.filter(F.col(key).isNotNull() & usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), labelled.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"), anchors.alias("asked"))
    rows = rows.filter("label IS NOT NULL")
    asked = rows.filter("asked").groupBy("id").agg(F.min(F.struct("v", "label")).alias("first")).select("id", "first.label", "first.v")
    n, n_asked, width = rows.agg(F.count("*"), F.count_if("asked"), F.max(F.size("v"))).first()
    counts = (n, n_asked, max(1, width or 0))
    best = lambda found, k: found.withColumn("rank", F.row_number().over(Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id"))).filter(F.col("rank") <= k)

    everything = lambda _: [(0, Wanted(-math.inf, math.inf, positives))]
    near = best(_by_blocks(rows.drop("asked"), asked.withColumn("windows", F.lit(None).cast("array<struct<rank:int,score:long>>")), counts, scale, everything, True, _FOUND), positives)
    near = stored(near.select("anchor_id", F.col("rank").alias("positive_rank"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))

    def between(windows: list[dict]) -> list[tuple[int, Wanted]]:
        """Integer scores s with low[0] * p <= low[1] * s and high[1] * s <= high[0] * p; a window of none is left out."""
        ends = [(w["rank"], -(-low[0] * w["score"] // low[1]), high[0] * w["score"] // high[1]) for w in windows]
        return [(rank, Wanted(first, last, negatives)) for rank, first, last in ends if first <= last]

    windows = near.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct(F.col("positive_rank").alias("rank"), F.col("positive_score").alias("score"))).alias("windows"))
    far = best(_by_blocks(rows.drop("asked"), asked.join(windows, "id"), counts, scale, between, False, _FOUND), negatives)
    far = far.select("anchor_id", F.col("window").alias("positive_rank"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return near.join(far, ["anchor_id", "positive_rank"]).select("anchor_id", "positive_id", "positive_rank", "positive_score", "rank", "negative_id", "negative_score")
