from __future__ import annotations

import random

import numpy as np
import xxhash
from llm.conftest import ODD

from promolens.llm import simhash


def plain(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + 3]), 42) for k in range(max(1, len(words) - 2))]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits - (1 << 64) if bits >> 63 else bits


def closure(values, distance=3):
    """Smallest reachable index of each value, by comparing all."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if bin((values[i] ^ values[j]) & (2**64 - 1)).count("1") <= distance:
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return [find(k) for k in range(len(values))]


def test_fingerprint():
    for text in [t for _, t in ODD] + ["A b C d", "É x", "one", "two words"]:
        assert simhash.fingerprint(text) == plain(text)


def test_anchors_within_two():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 2**32, 200, dtype=np.uint32)
    index, anchor, home = simhash.anchors(values)
    apart = np.bitwise_count(values[index] ^ anchor)
    assert apart.max() == 2 and apart[home].max() == 1 and home.sum() == 200
    for flip in range(32):
        other = values ^ np.uint32(1 << flip)
        i, a, _ = simhash.anchors(other)
        reached = set(zip(i.tolist(), a.tolist(), strict=True))
        assert all((int(k), int(x)) in reached for k, x, h in zip(index, anchor, home, strict=True) if h)


def clusters(seed, groups, size):
    rng = random.Random(seed)
    values = []
    for _ in range(groups):
        value = rng.getrandbits(64)
        for _ in range(rng.randrange(1, size)):
            values.append(value)
            for _ in range(rng.randrange(0, 5)):
                value ^= 1 << rng.randrange(64)
    return [v - (1 << 64) if v >> 63 else v for v in dict.fromkeys(values)]


def test_components_of_chains(spark):
    values = clusters(4, 40, 12) + clusters(5, 2, 150)
    want = closure(values)
    for hot in (simhash.HOT, 5):
        found = simhash.components(simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), hot)).collect()
        root = {r.node: r.root for r in found}
        got = [root.get(v, v) for v in values]
        groups: dict = {}
        for v, g, w in zip(values, got, want, strict=True):
            groups.setdefault(w, set()).add(g)
        assert all(len(g) == 1 for g in groups.values())
        assert len(groups) == len(set(got))


def test_near_duplicates(documents):
    rng = random.Random(6)
    rows = list(ODD)
    for k in range(60):
        words = [rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(rng.randrange(2, 300))]
        rows.append((100 + 3 * k, " ".join(words)))
        words[rng.randrange(len(words))] = "other"
        rows.append((101 + 3 * k, " ".join(words)))
        rows.append((102 + 3 * k, " ".join(words).upper()))
    got = simhash.near_duplicates(documents(rows)).collect()
    want = closure([plain(t) for _, t in rows])
    smallest: dict = {}
    for (i, _), w in zip(rows, want, strict=True):
        smallest[w] = min((x for x in (smallest.get(w), i) if x is not None), default=None)
    assert sorted((repr(r.doc_id), r.fp, r.component_id) for r in got) == sorted((repr(i), plain(t), smallest[w]) for (i, t), w in zip(rows, want, strict=True))
    assert simhash.near_duplicates(documents([])).count() == 0


def crowd(seed, size, side):
    """Fingerprints that differ in at most three bits of one half from one of them, and so share the other half's anchors."""
    rng = random.Random(seed)
    value = rng.getrandbits(64)
    values = {value: None}
    while len(values) < size:
        values[value ^ sum(1 << b for b in rng.sample(range(32 * side, 32 * side + 32), rng.randrange(1, 4)))] = None
    return [v - (1 << 64) if v >> 63 else v for v in values]


def test_crowded_anchor_links_its_own_fingerprints():
    for size in (32, 33, 200, 1300):
        values = crowd(size, size, 1)
        fp = np.array(values, dtype=np.int64)
        index, anchor, home = simhash.anchors(fp.astype(np.uint32))
        order = np.argsort(anchor, kind="stable")
        found = simhash.compare(anchor[order].astype(np.int64), fp[index][order], home[order])
        assert {v for pair in found for v in pair} <= set(values)
        assert all(bin((a ^ b) & (2**64 - 1)).count("1") in (1, 2, 3) for a, b in found)
        root = {v: v for v in values}
        for a, b in found:
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            root[max(a, b)] = min(a, b)
        assert sum(v == r for v, r in root.items()) == 1


def test_components_of_crowds(spark):
    values = crowd(1, 40, 0) + crowd(2, 300, 1) + clusters(3, 20, 6)
    want = closure(values)
    for hot in (simhash.HOT, 50):
        found = simhash.components(simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), hot)).collect()
        root = {r.node: r.root for r in found}
        assert set(root) <= set(values)
        assert {(w, root.get(v, v)) for v, w in zip(values, want, strict=True)} == {(w, min(v for v, x in zip(values, want, strict=True) if x == w)) for w in want}
