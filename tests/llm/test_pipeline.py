from __future__ import annotations

import hashlib
import random

import pytest
from llm.conftest import ODD
from llm.test_simhash import closure
from llm.test_simhash import plain as simhash_of
from llm.test_substrings import plain

import corpus_pipeline
from promolens.llm import simhash


def prose(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    out = list(ODD)
    passage = prose(rng, 60)
    for k in range(60):
        words = prose(rng, rng.randrange(80, 300))
        if k % 3 == 0:
            words = words[:40] + passage + words[40:]
        out.append((100 + 10 * k, " ".join(words)))
        if k % 2:
            out.append((101 + 10 * k, " ".join(words)))
            near = list(words)
            for at in range(30, len(near), 120):
                near[at] = "edited"
            out.append((102 + 10 * k, " ".join(near)))
    out += [(2005, " ".join(prose(rng, 90)) + " die.55@mail4.example.com"), (2006, "junk### " * 3 + " ".join(w + "###" for w in prose(rng, 60)))]
    out += [(3000 + k, " ".join(prose(rng, 50))) for k in range(60)]
    return out


def stays(rows):
    """Of each component of fingerprints, by comparing all, the row of the smallest key."""
    root = closure([simhash_of(t) for _, t in rows])
    best: dict = {}
    for (i, t), r in zip(rows, root, strict=True):
        best.setdefault(r, []).append((i is None, i or 0, simhash_of(t), i, t))
    return sorted(((min(group)[3], min(group)[4]) for group in best.values()), key=repr)


def test_near_dedup(documents, rows, spark):
    rng = random.Random(14)
    words = prose(rng, 3000)  # one edit in so long a text changes few bits
    crowd = [(5000 + k, " ".join([*words[: 20 * k], f"edited{k}", *words[20 * k + 1 :]])) for k in range(60)]
    many = rows + crowd + [(6000 + k, "one text of many copies") for k in range(200)]
    random.Random(15).shuffle(many)
    want = stays(many)
    for hot in (simhash.HOT, 3):
        frame = simhash.one_of_each_group(documents(many), hot=hot)
        assert sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr) == want and frame.columns == documents(many).columns
    assert sum(i is not None and 5000 <= i < 5060 for i, _ in want) < 30 and sum(i is not None and i >= 6000 for i, _ in want) == 1
    frame = corpus_pipeline.near_dedup(spark, documents(many), "")
    assert sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr) == want


def test_stages(documents, rows, spark):
    docs = documents(rows)
    good = corpus_pipeline.quality_rules(spark, docs, "")
    names = {r.doc_id for r in good.collect()}
    assert good.columns == docs.columns and not {1, 2, 3, 4, 5, 7, 2006, None} & names
    assert {i for i, _ in rows if i is not None and i >= 100} - {2006} <= names


    one = corpus_pipeline.near_dedup(spark, good, "")
    texts = {r.doc_id: r.text for r in one.collect()}
    cut = corpus_pipeline.substring_dedup(spark, one, "")
    want = {i: (n - g, h) for i, n, g, h in plain(texts.items())}
    for r in cut.collect():
        kept = r.text.split()
        assert (len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()) == want[r.doc_id] and r.n_chars == len(r.text)
    assert sum(len(r.text) for r in cut.collect()) < sum(map(len, texts.values()))
    masked = corpus_pipeline.personal_data(spark, cut, "")
    assert masked.columns == docs.columns and "mail4" not in " ".join(r.text for r in masked.collect())
    packed = corpus_pipeline.pack(spark, masked, "").collect()
    assert {r.doc_id for r in packed} == set(texts)


def test_empty_and_odd(documents, spark):
    for rows in ([], ODD):
        docs = documents(rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "")
        docs.collect()
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, documents(ODD), "").collect()


def test_run(spark):
    pieces = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert pieces.count() > 50 and {"doc_id", "sequence_id", "offset"} <= set(pieces.columns)
