from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from promolens.llm import negatives
from promolens.llm.queries import QUERIES

COLUMNS = "vec_id long, embedding array<float>, label int, block string, asked string, rank string, windows string, id string"
INF, NAN = float("inf"), float("nan")


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], COLUMNS)


def plain(rows, every, positives=5, k=3):
    """The definition: every anchor against every row."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], g) for i, v, g in rows if i is not None and g is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v, _ in kept), default=0)
    raw = {}
    for i, v, g in sorted(((i, v, g) for i, v, g in rows if i is not None and g is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)), key=lambda r: (r[0], r[1], r[2])):
        raw.setdefault(i, ([math.floor(256 * float(np.float32(x))) for x in v], g))
    out = []
    for anchor, (q, label) in raw.items():
        if anchor % every:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v, strict=False)), i, g) for i, v, g in kept if i != anchor]
        near = sorted((s, i) for s, i, g in scored if g == label)[:positives]
        for p, positive in near:
            far = sorted((s, i) for s, i, g in scored if g != label and 50 * -p <= 100 * -s <= 95 * -p)[:k]
            out += [(anchor, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(far, 1)]
    assert width >= 0
    return sorted(out)


def found(frame, every, **options):
    got = negatives.hard_negatives(frame, F.col("vec_id") % every == 0, **options)
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got.collect())


def made(rng, n, dims=12, labels=4):
    centres = [[rng.gauss(0, 0.3) for _ in range(dims)] for _ in range(5)]
    return [(k, [x + rng.gauss(0, 0.15) for x in rng.choice(centres)], rng.randrange(labels)) for k in range(n)]


@pytest.mark.parametrize("sizes", [None, (40, 7, 8, 2)])
def test_against_the_definition(vectors, monkeypatch, sizes):
    rng = random.Random(41)
    rows = made(rng, 260) + [(1000 + k, [0.2] * 12, k % 2) for k in range(130)]  # a third is one vector
    if sizes:
        monkeypatch.setattr(negatives, "VECTOR_BLOCK", sizes[0])
        monkeypatch.setattr(negatives, "ANCHOR_BLOCK", sizes[1])
    want = plain(rows, 10)
    assert len(want) > 100 and found(vectors(rows), 10) == want


def test_odd_rows(vectors):
    rng = random.Random(42)
    odd = [(None, [0.5] * 12, 1), (3, None, 1), (4, [None] * 12, 1), (5, [NAN] * 12, 1), (6, [INF] + [0.0] * 11, 2), (7, [0.5] * 12, None)]
    odd += [(10, [], 1), (11, [1.0], 1), (12, [0.9], 2), (13, [0.8], 1), (20, [0.3] * 13, 2), (20, [0.4] * 13, 2), (21, [0.3] * 13, 1), (21, [0.3] * 13, 1), (22, [0.4], 2), (30, [-0.2] * 12, 1)]
    for rows in (odd, odd + made(rng, 60)):
        assert found(vectors(rows), 10) == plain(rows, 10)
    assert found(vectors([]), 10) == [] and found(vectors(odd[:6]), 10) == [] and found(vectors(odd), 1000) == []
    assert isinstance(found(vectors([(k, [3e38] * 8, k % 2) for k in range(20)]), 10), list)


def test_tree_holds_all_rows_in_boxes():
    rng = np.random.default_rng(43)
    points = np.floor(rng.normal(size=(1000, 6)) * 50)
    tree = negatives.Tree(points, np.arange(1000), np.zeros(1000, dtype=np.int64), leaf=16, fan=4)
    assert sorted(tree.ids.tolist()) == list(range(1000)) and len(tree.low[-1]) == 1
    anchors = np.floor(rng.normal(size=(20, 6)) * 50)
    scores = anchors @ tree.points.T
    for level, (least, most) in enumerate(tree.intervals(anchors)):
        width = 16 * 4**level
        for node in range(least.shape[1]):
            part = scores[:, width * node : width * (node + 1)]
            assert (part >= least[:, [node]]).all() and (part <= most[:, [node]]).all()


def test_search_prunes():
    rng = np.random.default_rng(44)
    centres = rng.normal(size=(30, 4)) * 1000
    points = np.floor(centres[rng.integers(0, 30, 6000)] + rng.normal(size=(6000, 4)))
    tree = negatives.Tree(points, np.arange(6000), np.zeros(6000, dtype=np.int64), leaf=16, fan=4)
    for anchor in points[:20]:
        intervals = tree.intervals(anchor[None])
        scores = points @ anchor
        low = float(np.median(scores))
        wanted = [negatives.Wanted(-math.inf, math.inf, 5), negatives.Wanted(low, low + 1000, 3)]
        for w in wanted:
            read = tree.search(anchor, -1, np.ones(6000, dtype=bool), [w], [a[0] for a, _ in intervals], [b[0] for _, b in intervals])
            inside = np.flatnonzero((scores >= w.low) & (scores <= w.high))
            assert w.ids.tolist() == inside[np.lexsort((inside, -scores[inside]))][: w.k].tolist()
            assert read < len(tree.low[0]) / 4


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    rows = [(i, v, (g + 1) % 10 if g is not None and i % 7 == 0 else g) for i, v, g in rows]
    got = QUERIES["op13_negatives"](spark, folder).collect()
    assert sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got) == plain(rows, 50)
