from __future__ import annotations

import math
from collections import Counter

from llm.conftest import ODD
from pyspark.sql import functions as F

from promolens.llm import languages, queries

TEXTS = {"a": [b"the cat sat on the mat", b"that is the thing"], "b": [b"le chat est sur le tapis", b"\xc3\xa9t\xc3\xa9"]}


def plain_length(train, text):
    """Code length by walking the escapes one byte at a time."""
    seen = [Counter() for _ in range(4)]
    data = b"".join(b"\n\n\n" + t for t in train)
    for i in range(3, len(data)):
        for order in range(4):
            seen[order][data[i - order : i], data[i]] += 1
    total, kinds = Counter(), Counter()
    for order in range(4):
        for (context, _), n in seen[order].items():
            total[context] += n
            kinds[context] += 1
    bits, whole = 0.0, b"\n\n\n" + text
    for i in range(3, len(whole)):
        for order in (3, 2, 1, 0):
            context = whole[i - order : i]
            n, d, c = total[context], kinds[context], seen[order][context, whole[i]]
            if c:
                bits -= math.log2(c / (n + d))
                break
            if n:
                bits -= math.log2(d / (n + d))
        else:
            bits += 8
    return bits


def test_lengths_are_exact(monkeypatch):
    trees = languages.ContextTrees(TEXTS)
    texts = [b"the mat", b"", b"x", b"zzz \xff unseen le chat", b"the cat sat on the mat" * 20]
    for size in (languages.SLICE, 7):
        monkeypatch.setattr(languages, "SLICE", size)
        for text, row in zip(texts, trees.lengths(texts), strict=True):
            for language, bits in zip(trees.languages, row, strict=True):
                assert math.isclose(bits, plain_length(TEXTS[language], text), rel_tol=1e-5, abs_tol=1e-4)


def test_odd_rows(documents):
    rows = ODD + [(8, "123 45"), (9, "the cat"), (10, "le tapis")]
    got = {r.doc_id: r for r in languages.identify(documents(rows), languages.ContextTrees(TEXTS)).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3, 8)] == ["und"] * 4 and got[1].score == 0
    assert got[9].lang_pred == "a" and got[10].lang_pred == "b" and 0.5 < got[10].score <= 1
    none = languages.train(documents([]))
    assert {r.lang_pred for r in languages.identify(documents(rows), none).collect()} == {"und"}
    assert languages.identify(documents([]), none).count() == 0
    some = languages.train(documents(rows, lang=lambda i: None if i == 7 else "en"), rows=3)
    assert some.languages == ["en"]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = queries.QUERIES["op6_languages"](spark, folder).join(truth, "doc_id")
    held = rows.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert held > 0.98 and rows.count() == 1000


def test_a_language_of_long_texts_is_learned(spark, monkeypatch):
    monkeypatch.setattr(languages, "SAMPLE_BYTES", 5000)
    rows = [(k, "aba bab abba " * 2000, "long") for k in range(3)] + [(10 + k, "xyz zyx yx " * 20, "short") for k in range(60)]
    trees = languages.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert trees.languages == ["long", "short"]
    asked = spark.createDataFrame([(1, "abba bab"), (2, "zyx xyz")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in languages.identify(asked, trees).collect()} == {1: "long", 2: "short"}


def same_trees(a, b):
    pairs = [pair for name in ("keys", "costs", "escapes") for pair in zip(getattr(a, name), getattr(b, name), strict=True)]
    return a.languages == b.languages and all(x.shape == y.shape and (x == y).all() for x, y in pairs)


def test_counts_of_spark_are_those_of_the_texts(spark):
    rows = [(k, text, lang) for k, (lang, text) in enumerate([("a", "the cat"), ("b", "le chat été"), ("a", ""), ("a", "the cat"), ("c", "x")])]
    rows += [(90, None, "a"), (91, "gone", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    texts: dict = {}
    for _, text, lang in rows[:5]:
        texts.setdefault(lang, []).append(text.encode())
    # a last empty text puts line feeds after the one before it
    assert same_trees(languages.train(frame), languages.ContextTrees({lang: [*own, b""] for lang, own in texts.items()}))
    assert languages.train(frame.limit(0)).languages == []


def test_a_bounded_tree_keeps_the_most_frequent_paths(monkeypatch):
    texts = {"a": [b"abab" * 50 + b"qwertzuiop", b""], "b": [b"cdcd" * 50 + b"asdfghjkl", b""]}
    full = languages.ContextTrees(texts)
    monkeypatch.setattr(languages, "MODEL_CELLS", 24)
    small = languages.ContextTrees(texts)
    assert all(len(keys) <= 12 for keys in small.keys[2:]) and len(full.keys[3]) > 12 and len(small.keys[3])
    assert small.predict([b"ababab", b"cdcdcd", b"qwertz"])[0] == full.predict([b"ababab", b"cdcdcd", b"qwertz"])[0] == ["a", "b", "a"]
    for text in (b"abab", b"xyz", b"", b"qwertz" * 9):
        assert all(math.isfinite(bits) for bits in small.lengths([text])[0])


def test_languages_share_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(languages, "MODEL_BYTES", 2000)
    rows = [(k, f"{'ab'[k % 2] * 99}\n", "ab"[k % 2]) for k in range(60)]
    monkeypatch.setattr(languages.ContextTrees, "of_counts", classmethod(lambda cls, counts: counts))
    counts = languages.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {lang: int(n.sum()) for lang, (_, n) in counts.items()} == {"a": 1030, "b": 1030}
