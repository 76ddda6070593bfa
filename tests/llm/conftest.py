from __future__ import annotations

import pytest

ROWS = "doc_id long, text string, lang string, source string, n_chars long, _bucket string, shard string, size string, key string, windows string, Masked string, kept_key string, found_hash string"


@pytest.fixture
def documents(spark):
    """A table of (doc_id, text) with further columns whose names clash with the operators' own."""

    def make(rows, lang=None):
        full = [(i, t, lang(i) if lang else "en", "s", None if t is None else len(t), "x", "y", "z", "w", "v", "u", "t", "s") for i, t in rows]
        return spark.createDataFrame(full, ROWS)

    return make


#: Null, empty, blank, repeated, tied and long texts, and a null id.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a b c"), (4, "a b c"), (5, "a b c"), (None, "x"), (6, "Ünï çödé 日本 😀 " * 40), (7, "word " * 5000)]
