from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from promolens.llm import codes
from promolens.llm.queries import QUERIES

COLUMNS = "vec_id long, embedding array<float>, label int, code string, error string, key string, n string, _label string"
INF, NAN = float("inf"), float("nan")


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], COLUMNS)


def plain(rows, scale=4096, parts=8, entries=16, rounds=6):
    """The definition, one part of one vector at a time."""
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v], g) for i, v, g in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return [], ""
    part = max(1, -(-max(len(v) for _, v, _ in kept) // parts))
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    filled = lambda rows: [(i, v + [0] * (part * parts - len(v)), g) for i, v, g in rows]
    kept, first = filled(kept), filled(first)
    books = [[v[k * part : (k + 1) * part] for _, v, _ in first] for k in range(parts)]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, entry, strict=True)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for k, book in enumerate(books):
            members: dict = {}
            for _, v, _ in kept:
                x = v[k * part : (k + 1) * part]
                members.setdefault(nearest(book, x)[1], []).append(x)
            books[k] = [[sum(c) // len(members[e]) for c in zip(*members[e], strict=True)] if e in members else entry for e, entry in enumerate(book)]
    out = []
    for i, v, g in kept:
        found = [nearest(books[k], v[k * part : (k + 1) * part]) for k in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), g))
    total: dict = {}
    for _, _, error, g in out:
        total[g] = total.get(g, 0) + error
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted(((i, c, e, total[g]) for i, c, e, g in out), key=repr), digest


def found(frame):
    done = codes.compress(frame)
    return sorted(((r.key, r.code, r.error, r.label_error) for r in done.with_label_errors().collect()), key=repr), done.digest


def made(rng, n, dims=16):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    return [(k, [x + rng.gauss(0, 0.2) for x in rng.choice(centres)], rng.randrange(4)) for k in range(n)]


def test_against_the_definition(vectors):
    rng = random.Random(31)
    rows = made(rng, 300)
    same = [(1000 + k, [0.25] * 16, 1) for k in range(150)]  # a third of all rows
    assert found(vectors(rows + same)) == plain(rows + same)


def test_odd_rows(vectors):
    rng = random.Random(32)
    odd = [(None, [0.5] * 16, 1), (None, [0.5] * 16, None), (3, None, 1), (4, [None] * 16, 1), (5, [NAN] * 16, 1), (6, [INF] + [0.0] * 15, 2)]
    odd += [(7, [], None), (7, [1.0], None), (7, [1.0], None), (8, [-0.00001] * 16, 3), (9, [2.0] * 19, 3)]
    for rows in (odd, odd + made(rng, 40), odd[:2], odd[6:7], [(k, [float(k % 2)] * 8, None) for k in range(40)]):
        assert found(vectors(rows)) == plain(rows)
    assert found(vectors([]))[0] == [] and found(vectors(odd[2:6]))[0] == []


def test_very_large_components(vectors):
    rows = [(k, [3e38 * (-1) ** k] * 16, k % 2) for k in range(30)]
    assert len(found(vectors(rows))[0]) == 30


def test_orchard_finds_the_nearest_of_lowest_index():
    rng = np.random.default_rng(33)
    for entries in (1, 2, 16, 100):
        for high in (2, 50):  # few values make many ties and equal entries
            book, points = rng.integers(0, high, (entries, 4)), rng.integers(-1, high + 1, (500, 4))
            away = ((points[:, None] - book[None]) ** 2).sum(axis=2)
            best, least = codes.Orchard(book).nearest(points)
            assert (best == away.argmin(axis=1)).all() and (least == away.min(axis=1)).all()


def test_orchard_skips_far_entries():
    rng = np.random.default_rng(34)
    centres = rng.normal(size=(16, 8)) * 1000
    points = (centres[rng.integers(0, 16, 2000)] + rng.normal(size=(2000, 8)) * 20).astype(np.int64)
    search = codes.Orchard(centres.astype(np.int64))
    looked = []
    search.lists = type("Counted", (), {"__getitem__": lambda _, at, lists=search.lists: looked.append(len(at[0])) or lists[at]})()
    search.nearest(points)
    assert sum(looked) < 0.5 * 2000 * 15


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = QUERIES["op12_codes"](spark, folder).collect()
    want, digest = plain(rows)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=repr) == want and {r.codebooks_sha256 for r in got} == {digest}
