from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from llm.conftest import ODD

from promolens.llm import substrings


def plain(rows):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least: dict = {}
    for i, w in words:
        for k in range(len(w) - 12):
            if i is not None:
                least[tuple(w[k : k + 13])] = min(i, least.get(tuple(w[k : k + 13]), i))
    out = []
    for i, w in words:
        gone = {k + j for k in range(len(w) - 12) if i is not None and least[tuple(w[k : k + 13])] < i for j in range(13)}
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    common = ["the", "of", "and", "in"]
    word = lambda: rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 6)))
    passages = [[word() for _ in range(rng.randrange(10, 80))] for _ in range(8)]
    rows = list(ODD)
    for k in range(150):
        text: list = []
        for _ in range(rng.randrange(1, 4)):
            text += [word() for _ in range(rng.randrange(0, 40))]
            if rng.random() < 0.7:
                part = list(rng.choice(passages))
                if rng.random() < 0.3:
                    part[rng.randrange(len(part))] = "changed"
                text += part[rng.randrange(0, 5) :]
        rows.append((rng.randrange(100, 220), rng.choice([" ", "\n", "  "]).join(text)))
    return rows + [(300, rows[20][1]), (301, rows[20][1]), (302, "x " * 40), (303, "x " * 50)]


@pytest.mark.parametrize("hot", [substrings.HOT, 5])
def test_against_brute_force(documents, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "INDEX_WORDS", substrings.INDEX_WORDS if hot > 5 else 200)
    rows = corpus(hot)
    got = sorted((tuple(r) for r in substrings.digests(documents(rows)).collect()), key=repr)
    assert got == plain(rows)


def test_empty(documents):
    assert substrings.digests(documents([])).count() == 0
    assert substrings.remove_repeated(documents([(1, None), (None, "a")])).count() == 2


def test_removed_text(documents):
    words = [f"w{k}" for k in range(40)]
    rows = [(1, " ".join(words)), (2, "before this\n" + "  ".join(words[5:30]) + "\n\nand after"), (3, "clean")]
    got = {r.doc_id: r for r in substrings.remove_repeated(documents(rows)).collect()}
    assert got[1].text == rows[0][1] and got[2].text == "before this\nand after" and got[3].text == "clean" and got[2].key == "w"


def test_index_counts_and_intervals():
    rng = np.random.default_rng(11)
    text = rng.integers(0, 5, 4000)
    text[500:560] = text[3000:3060]
    index = substrings.FmIndex(text, 5)
    order = sorted(range(len(text)), key=lambda k: ([*text[k : k + 13].tolist(), *[-1] * 13])[:13])
    assert [text[k : k + 13].tolist() for k in index.order if k < 3980] == [text[k : k + 13].tolist() for k in order if k < 3980]
    begins = np.arange(0, 3980)
    found = index.search(text, begins)
    windows = [tuple(text[b : b + 13].tolist()) for b in begins]
    many = {w for w in windows if windows.count(w) > 1} if len(set(windows)) < len(windows) else set()
    for b, at in zip(begins.tolist(), found.tolist(), strict=True):
        assert (at >= 0) == (windows[b] in many)
        if at >= 0:
            assert tuple(text[index.order[at] :][:13].tolist()) == windows[b]
    for symbol in range(5):
        places = np.arange(0, 4001, 37)
        want = [(text[index.order - 1][:p] == symbol).sum() for p in places]
        assert index.index.rank(np.full(len(places), symbol), places).tolist() == want
