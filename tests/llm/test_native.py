from __future__ import annotations

import re

import duckdb
import numpy as np
import pytest
from llm.conftest import ODD
from pyspark.sql import functions as F

from promolens.llm import licenses, oracle, quality, queries, vectors

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_against_sql(spark, name):
    base = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        base.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    frame = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    want = base.execute(f"select {', '.join(columns)} from ({oracle.oracle_sql()[name]})").fetchall()
    got = [tuple(r[c] for c in columns) for r in frame.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and got


def test_no_python_in_native_plans(documents):
    for frame in (licenses.scan(documents(ODD)), quality.measured(documents(ODD))):
        plan = frame._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


GRANT = licenses.TEMPLATES["mit"][0]
TEXTS = [
    (20, "Released under the MIT License."),
    (21, "Apache License, Version 2.0. under the mit license under the MIT license"),
    (22, "x CC BY-NC 4.0"),
    (23, GRANT.upper()),
    (24, "before " + GRANT.replace("without limitation", "but not limited to any").replace(" publish", "") + " after"),
    (25, "apache license versions 2 under the mitt license cc bync"),
    (26, "permission is hereby granted free of charge"),
    (27, "under the mİt license"),
]


def test_license_rows(documents):
    got = {r.key: r for r in licenses.scan(documents(ODD + TEXTS)).collect()}
    assert licenses.scan(documents(ODD + TEXTS)).count() == len(ODD + TEXTS)
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    assert all(got[i].n_words == len(words(t)) for i, t in ODD + TEXTS)
    assert (got[20].labels, got[20].n_base, got[20].first_word, got[20].last_word, got[20].score) == ("mit", 1, 1, 1, 1.0)
    assert (got[21].labels, got[21].n_base, got[21].first_word, got[21].last_word) == ("apache-2,mit", 3, 0, 9)
    assert got[22].base_labels == "cc-by-nc" and got[23].base_labels == "" and got[23].labels == "mit" and got[23].score == 1.0
    assert got[24].labels == "mit" and 0.6 <= got[24].score < 1
    assert [got[k].labels for k in (1, 2, 3, 4, 25, 26, 27)] == [""] * 7 and got[1].score == 0 and got[1].first_word is None
    assert licenses.scan(documents([])).count() == 0


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    repeated = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def test_quality_counts(documents):
    rng = np.random.default_rng(8)
    rows = [(i, t) for i, t in ODD if i != 7] + [(8, "word " * 300)]
    rows += [(100 + k, " ".join(rng.choice(list("abc#*"), rng.integers(1, 90), p=[0.5, 0.2, 0.1, 0.1, 0.1])) + "\nx y\nx y") for k in range(60)]
    got = quality.measured(documents(rows)).collect()
    want = [(i, *plain_counts(t)) for i, t in rows]
    assert sorted(((r.key, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=repr) == sorted(want, key=repr)


def test_quality_verdicts(documents):
    rng = np.random.default_rng(9)
    prose = lambda: " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 8))) for _ in range(100))
    rows = [(k, prose()) for k in range(150)] + [(200 + k, prose().replace(" ", "### ")) for k in range(10)] + [(300, "x"), (301, None)]
    got = {r.key: r for r in quality.assess(documents(rows, lang=lambda i: "en" if i < 300 and i % 50 else None)).collect()}
    assert len(got) == len(rows)
    assert all(got[k].kept for k in range(150)) and not any(got[200 + k].kept for k in range(10))
    assert got[300].base_failed and got[301].base_failed and not got[301].kept
    assert quality.assess(documents([])).count() == 0


def plain_top(rows, k=10):
    use = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in use if i % 100 == 0}):
        mine = min(v for i, v in use if i == q)
        scores = sorted((-sum(a * b for a, b in zip(mine, v, strict=False)), i) for i, v in use if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return out


def test_top_k(spark, monkeypatch):
    rng = np.random.default_rng(10)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(700)]
    rows += [(800, [0.0] * 6), (801, rows[3][1]), (802, rows[3][1]), (803, rows[3][1]), (3, rows[3][1]), (900, None), (901, [float("nan")] * 6), (902, [None] * 6)]
    rows += [(None, rows[5][1]), (903, []), (904, [1.0, 2.0]), (905, [float("inf")] * 6), (1000, [0.5] * 6), (1000, [0.5] * 6)]
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, id string, asked string")
    ask = F.col("vec_id") % 100 == 0
    for block in (8192, 50):
        monkeypatch.setattr(vectors, "VECTOR_BLOCK", block)
        monkeypatch.setattr(vectors, "QUERY_BLOCK", max(4, block // 25))
        got = [tuple(r) for r in vectors.top_k(frame, ask).collect()]
        assert sorted(got) == plain_top(rows)
    assert vectors.top_k(frame.limit(0), ask).count() == 0
    assert sorted(tuple(r) for r in vectors.top_k(frame.filter("vec_id in (100, 7)"), ask).collect()) == plain_top([r for r in rows if r[0] in (100, 7)])


def test_large_components():
    big = np.array([[2.0**70, -(2.0**70)], [1.0, 2.0]])
    assert vectors._products(big, big).tolist() == [[2**63 - 1, -(2**63)], [-(2**63), 5]]


def test_license_with_many_insertions(documents):
    """Words put in at several places drift the diagonals apart; what counts is how much of the template is there."""
    words = GRANT.split()
    rows = []
    for k, cuts in enumerate(((10,), (10, 20, 30), (5, 15, 25, 35, 45), range(4, 46, 3))):
        with_more = [w for at, word in enumerate(words) for w in ([*(f"put{at}{n}" for n in range(3)), word] if at in cuts else [word])]
        rows.append((k, "before " + " ".join(with_more) + " after"))
    rows.append((9, " ".join(f"{a} x{n}" for n, a in enumerate(words))))  # all words, none of the grams
    got = {r.key: r for r in licenses.scan(documents(rows)).collect()}
    assert [got[k].labels for k in (0, 1, 2, 3, 9)] == ["mit", "mit", "mit", "", ""]
    grams = {tuple(words[k : k + 3]) for k in range(len(words) - 2)}
    for k in (0, 1, 2):
        own = rows[k][1].split()
        assert got[k].score == pytest.approx(len(grams & {tuple(own[j : j + 3]) for j in range(len(own) - 2)}) / len(grams))


def test_repeated_grams_of_a_template_count_once(documents):
    part = " ".join(GRANT.split()[:12])
    assert [r.labels for r in licenses.scan(documents([(1, " ".join([part] * 40))])).collect()] == [""]


def test_license_work_is_in_proportion_to_the_text(documents):
    import time

    def seconds(n):
        begun = time.perf_counter()
        assert [r.labels for r in licenses.scan(documents([(1, "some words and more " * (n // 4) + GRANT)])).collect()] == ["mit"]
        return time.perf_counter() - begun

    seconds(20_000)
    short, long = seconds(80_000), seconds(320_000)
    assert long < 8 * short + 2


def test_word_length_beyond_two_thousand_hundredths(documents):
    """A limit above every bucket of ordinary words still parts longer words from shorter ones."""
    rng = np.random.default_rng(11)
    word = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    rows = [(k, " ".join(word(int(n)) for n in rng.integers(15, 26, 60))) for k in range(120)] + [(500, " ".join(word(400) for _ in range(60)))]
    got = {r.key: r for r in quality.assess(documents(rows)).collect()}
    assert got[500].word_length == 40_000 > got[500].max_word_length > 2000 and not got[500].kept
    assert sum(got[k].kept for k in range(120)) > 110


def test_buckets_keep_the_leading_bits(spark):
    values = [0, 1, 2047, 2048, 2049, 4095, 4096, 40_000, 10**9 + 7]
    frame = spark.createDataFrame([(v,) for v in values], "m long").select(quality._bucket("m").alias("b"))
    assert [r.b for r in frame.collect()] == [v >> s << s for v in values for s in [max(0, v.bit_length() - 11)]]


@pytest.mark.parametrize("texts", [1, 49, 50])
def test_scripted_measures_are_not_judged_by_other_languages(documents, texts):
    rng = np.random.default_rng(12)
    word = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    prose = [(k, " ".join(word(int(n)) for n in rng.integers(2, 8, 60))) for k in range(200)]
    long = [(1000 + k, " ".join(word(int(n)) for n in rng.integers(13, 18, 60))) for k in range(texts)]
    got = {r.key: r for r in quality.assess(documents(prose + long, lang=lambda i: "th" if i >= 1000 else "en")).collect()}
    assert all(got[1000 + k].kept for k in range(texts)) and all(got[k].kept for k in range(200))
    assert (got[1000].max_word_length is None) == (texts < 50) and got[1000].max_symbols is not None


@pytest.mark.parametrize("cells", [1, 4, 256])
def test_bounds_from_codes_hold_and_spare_reads(cells, monkeypatch):
    rng = np.random.default_rng(4)
    wild = rng.normal(size=(400, 5)) * 10.0 ** rng.integers(-3, 7, size=(400, 5))
    for exact in (np.floor(1024 * rng.normal(size=(900, 12))), np.floor(wild), np.zeros((5, 3)), np.full((7, 2), 3.0)):
        file = vectors.ApproximationFile(exact, cells)
        assert file.codes.dtype == np.uint8
        low, gap = file.bounds(exact[:50])
        products = exact[:50] @ exact.T
        assert (low <= products).all() and (products <= low + gap[:, None]).all()
        ids = np.arange(len(exact))
        want = [(q, int(i), int(products[q, i])) for q in ids[:50] for i in [j for j in np.lexsort((ids, -products[q])) if j != q][:10]]
        assert vectors.search(ids, exact, ids[:50], exact[:50], 10, cells) == want
    read = []
    monkeypatch.setattr(vectors, "_products", lambda a, b, real=vectors._products: read.append(len(b)) or real(a, b))
    many = np.floor(1024 * rng.normal(size=(8192, 64)))
    vectors.search(np.arange(8192), many, np.arange(100), many[:100], 10)
    assert sum(read) < 100 * 8192 / 50
