"""License scans by diagonal voting: word k-grams joined to template positions, counted by offset, merged, verified.

Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words of a gram.
K = 3
#: Diagonals this far apart or less are one occurrence with words inserted or left out.
DRIFT = 3
#: Share of a template's grams that an occurrence must have.
COVERAGE = 0.6
#: Templates are broadcast; more grams than this are refused.
MOST_GRAMS = 100_000

#: Phrases that name a license, word for word.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Sentences of public licenses, lower-cased words only, that are found although some words differ.
TEMPLATES = {
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software",
    ),
    "apache-2": ("you may not use this file except in compliance with the license you may obtain a copy of the license at",),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",),
    "gpl": (
        "this work is licensed under the gnu general public license version 3",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    ),
    "mpl": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
    "cc-by": ("this work is licensed under a creative commons attribution 4 0 international license",),
    "cc-by-sa": ("this work is licensed under a creative commons attribution sharealike 4 0 international license",),
    "cc-by-nc": ("this work is licensed under a creative commons attribution noncommercial 4 0 international license",),
    "cc0": ("to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",),
    "proprietary": ("all rights reserved no part of this publication may be reproduced distributed or transmitted in any form or by any means",),
}
_BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def license_words(text: Column) -> Column:
    """Words of ASCII letters and digits and of all other characters, lower-cased; none for null.

    Lower-casing all letters instead of A-Z alone changes neither where words end nor which equal a template's ASCII
    words, since no other letter of these becomes an ASCII letter.
    """
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _BREAKS), "")


def _grams(words: Column) -> Column:
    size = F.size(words)
    places = F.when(size >= K, F.sequence(F.lit(0), size - K)).otherwise(F.array().cast("array<int>"))
    return F.transform(F.transform(places, lambda i: F.slice(words, i + 1, K)), lambda gram: F.struct(F.xxhash64(gram).alias("hash"), gram.alias("gram")))


def template_grams(spark: SparkSession, phrases: dict[str, str] = PHRASES, templates: dict[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """One row per gram of each template, and one row, of template -1, that the header gram of every text meets."""
    entries = [(text, label, True) for text, label in phrases.items()] + [(text, label, False) for label, texts in templates.items() for text in texts]
    short = [text for text, _, _ in entries if len(text.split()) < K]
    if short or sum(len(text.split()) for text, _, _ in entries) > MOST_GRAMS:
        raise ValueError(f"templates need {K} words or more, and {MOST_GRAMS} in all or fewer: {short}")
    rows = F.array(*(F.struct(F.lit(n).alias("template"), F.lit(label).alias("label"), F.lit(exact).alias("exact"), F.split(F.lit(text), " ").alias("words")) for n, (text, label, exact) in enumerate(entries)))
    one = spark.range(1).select(F.inline(rows))
    grams = one.select("template", "label", "exact", "words", (F.size("words") - K + 1).alias("grams"), F.posexplode(_grams(F.col("words"))).alias("at", "own"))
    own = grams.select("own.hash", "template", "label", "exact", "grams", "at", F.col("own.gram").alias("wanted"))
    header = spark.range(1).select(
        F.lit(0).cast("long").alias("hash"), F.lit(-1).alias("template"), F.lit(None).cast("string").alias("label"), F.lit(False).alias("exact"),
        F.lit(0).alias("grams"), F.lit(0).alias("at"), F.array().cast("array<string>").alias("wanted"),
    )
    return own.union(header)


def occurrences(docs: DataFrame, templates: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Occurrences of templates in every whole text: (row, key, n_words, template, label, exact, coverage, first, last).

    ``row`` tells repeated rows apart. Every text has a header row of template -1, so that none is lost. Grams meet
    template positions in a join with the broadcast templates, and equal hashes are verified word by word there; a
    gram carries its own words only, so the work is in proportion to the text. What matches is partitioned by row, counted
    by the diagonal (place in the text less place in the template), and neighbouring diagonals are merged. An occurrence
    needs all grams of a phrase on one diagonal, or on a chain of neighbouring ones COVERAGE of a template's grams, each
    counted once; how often words were inserted or left out on the way does not matter.
    """
    words = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), license_words(F.col(text)).alias("words"))
    header = F.array(F.struct(F.lit(0).cast("long").alias("hash"), F.array().cast("array<string>").alias("gram")))
    listed = words.select("row", "key", F.size("words").cast("long").alias("n_words"), F.concat(header, _grams(F.col("words"))).alias("grams_of"))
    exploded = listed.select("row", "key", "n_words", F.posexplode("grams_of").alias("place", "own")).select("row", "key", "n_words", "place", "own.hash", "own.gram")
    met = exploded.join(F.broadcast(templates), "hash").filter((F.col("place") == 0) == (F.col("template") == -1)).filter(F.col("gram") == F.col("wanted"))
    votes = (
        met.select("row", "key", "n_words", "template", "label", "exact", "grams", (F.col("place") - 1).alias("place"), (F.col("place") - 1 - F.col("at")).alias("diagonal"))
        .repartition("row")
        .groupBy("row", "template", "diagonal")
        .agg(*(F.first(c).alias(c) for c in ("key", "n_words", "label", "exact", "grams")), F.collect_set(F.col("place") - F.col("diagonal")).alias("met"), F.min("place").alias("first"), F.max("place").alias("last"))
    )
    own = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(own) > DRIFT, F.lit(True)) | F.col("exact")
    merged = (
        votes.withColumn("apart", apart.cast("int"))
        .withColumn("group", F.sum("apart").over(own))
        .groupBy("row", "template", "group")
        .agg(*(F.first(c).alias(c) for c in ("key", "n_words", "label", "exact", "grams")), F.size(F.array_distinct(F.flatten(F.collect_list("met")))).alias("votes"), F.min("first").alias("first"), F.max("last").alias("last"))
    )
    coverage = F.least(F.lit(1.0), F.col("votes") / F.greatest(F.col("grams"), F.lit(1)))
    real = (F.col("template") == -1) | F.when(F.col("exact"), F.col("votes") == F.col("grams")).otherwise(coverage >= COVERAGE)
    return merged.filter(real).select("row", "key", "n_words", "template", "label", "exact", coverage.alias("coverage"), F.col("first").cast("long").alias("first"), (F.col("last") + K - 1).cast("long").alias("last"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: n_words, n_base places of phrases and the first and last of them, base_labels,
    labels of phrases and templates, and the best coverage as score (0 without any).

    Null, empty and blank texts have no words and no labels; repeated rows and null keys are kept; an empty table
    gives no rows; other columns are not read.
    """
    found = occurrences(docs, template_grams(docs.sparkSession), key, text)
    base = F.when(F.col("exact"), F.col("first"))
    join = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return found.groupBy("row").agg(
        F.first("key").alias("key"),
        F.first("n_words").alias("n_words"),
        F.count(base).alias("n_base"),
        F.min(base).alias("first_word"),
        F.max(base).alias("last_word"),
        join(F.when(F.col("exact"), F.col("label"))).alias("base_labels"),
        join(F.col("label")).alias("labels"),
        F.max(F.when(F.col("template") >= 0, F.col("coverage")).otherwise(F.lit(0.0))).alias("score"),
    )
