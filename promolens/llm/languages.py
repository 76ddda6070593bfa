"""Language identification by prediction by partial matching: code lengths under frozen byte context trees."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import map_rows, parts_of

#: The longest context, in bytes, and the line feeds that stand before every text in place of a context.
ORDER = 3
_START = b"\n" * ORDER
#: The training sample: rows of each language, and their bytes; a longer text is drawn only if it is the language's first.
SAMPLE_ROWS, SAMPLE_BYTES = 400, 32 << 20
#: Bytes that all languages share evenly, and so the most counts that reach the driver; and the most costs, paths times
#: languages, of one depth of the trees.
MODEL_BYTES, MODEL_CELLS = 64 << 20, 1 << 26
#: The most languages that are learned, those with the most texts.
LANGUAGES = 1000
#: Bytes of text that a worker scores at a time.
SLICE = 1 << 19
UNKNOWN = "und"


def grams_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The different runs of three bytes and a fourth, as numbers, and how often each occurs."""
    raw = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    paths = np.zeros(max(len(raw) - ORDER, 0), dtype=np.uint32)
    for k in range(ORDER + 1):
        paths = paths << np.uint32(8) | raw[k : len(raw) - ORDER + k]
    return np.unique(paths, return_counts=True)


Grams = list[tuple[np.ndarray, np.ndarray]]


def _most_frequent(grams: Grams, most: int, shorter: Grams | None) -> Grams:
    """The paths of highest total count, ties to smaller ones, whose context and end are among the shorter ones."""
    if not grams:
        return grams
    paths, which = np.unique(np.concatenate([own for own, _ in grams]), return_inverse=True)
    if len(paths) > most:
        total = np.bincount(which, weights=np.concatenate([n for _, n in grams]))
        paths = np.sort(paths[np.argsort(-total, kind="stable")[:most]])
    if shorter is not None:
        known = np.unique(np.concatenate([own for own, _ in shorter]))
        paths = paths[np.isin(paths >> np.uint32(8), known) & np.isin(paths & np.uint32(0xFFFFFF), known)]
    return [(own[held], n[held]) for own, n in grams for held in [np.isin(own, paths)]]


class ContextTrees:
    """Byte context trees of depth three for several languages, with costs in bits ready for each seen path.

    In a context with n training bytes, d of them different, a byte seen c times costs -log2(c / (n + d)); others
    cost an escape, -log2(d / (n + d)), and what they cost in the context shorter by one byte; below the empty
    context every byte costs 8 bits. Contexts never seen cost nothing to leave. Escapes exclude no symbols. Beyond
    MODEL_CELLS costs a depth, rarer paths of three and four bytes are left out, as if never seen.
    """

    def __init__(self, texts: dict[str, list[bytes]]) -> None:
        self._build({language: grams_of(b"".join(_START + text for text in own)) for language, own in texts.items()})

    @classmethod
    def of_counts(cls, counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> ContextTrees:
        """Trees of the counted paths of three bytes of context and the next byte of each language."""
        trees = cls.__new__(cls)
        trees._build(counts)
        return trees

    def _build(self, deepest: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        """Shorter paths are the ends of the longer ones and counted by adding those up."""
        self.languages = sorted(deepest)
        wide = len(self.languages)
        grams: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(ORDER + 1)]
        for language in self.languages:
            paths, n = deepest[language]
            for order in range(ORDER + 1):
                ends, which = np.unique(paths & np.uint32((1 << 8 * (order + 1)) - 1), return_inverse=True)
                grams[order].append((ends, np.bincount(which, weights=n, minlength=len(ends))))
        for order in range(2, ORDER + 1):
            grams[order] = _most_frequent(grams[order], MODEL_CELLS // max(1, wide), grams[order - 1] if order == ORDER else None)
        self.keys: list[np.ndarray] = []
        self.costs: list[np.ndarray] = []
        self.escapes: list[np.ndarray] = []  # by the key of the context, one order lower
        shorter = np.full((256, wide), 8.0)
        for order in range(ORDER + 1):
            keys = np.unique(np.concatenate([k for k, _ in grams[order]])) if wide else np.empty(0, np.uint32)
            if order <= 1:
                keys = np.arange(256 << 8 * order, dtype=np.uint32)
            counts = np.zeros((len(keys), wide))
            for k, (seen, n) in enumerate(grams[order]):
                counts[np.searchsorted(keys, seen), k] = n
            contexts = self.keys[-1] if order else np.zeros(1, np.uint32)
            at = np.searchsorted(contexts, keys >> np.uint32(8))
            total, kinds = np.zeros((len(contexts), wide)), np.zeros((len(contexts), wide))
            np.add.at(total, at, counts)
            np.add.at(kinds, at, counts > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                own = -np.log2(counts / (total + kinds)[at])
            below = shorter[np.searchsorted(self.keys[-1], keys & np.uint32((1 << 8 * order) - 1))] if order else shorter
            shorter = np.where(counts > 0, own, escape[at] + below)
            self.keys.append(keys)
            self.costs.append(shorter.astype(np.float32))
            self.escapes.append(escape.astype(np.float32))
        self.steps: tuple[np.ndarray, np.ndarray] | None = None

    def _steps(self) -> tuple[np.ndarray, np.ndarray]:
        """From a path's row and the next byte to the row of the path longer by it, -1 if never seen."""
        if self.steps is None:
            built = []
            for order in (2, 3):
                step = np.full(len(self.keys[order - 1]) << 8, -1, dtype=np.int32)
                context = np.searchsorted(self.keys[order - 1], self.keys[order] >> np.uint32(8))
                step[(context << 8) + (self.keys[order] & np.uint32(255))] = np.arange(len(self.keys[order]), dtype=np.int32)
                built.append(step)
            self.steps = (built[0], built[1])
        return self.steps

    def __getstate__(self) -> dict:
        return self.__dict__ | {"steps": None}

    def costs_of(self, data: bytes) -> np.ndarray:
        """Bits of each byte but the first three, which serve as context: one row a byte, one column a language."""
        two_three, three_four = self._steps()
        raw = np.frombuffer(data, dtype=np.uint8).astype(np.int32)
        pair = (raw[:-1] << 8) + raw[1:]
        triple = two_three[(pair[:-1] << 8) + raw[2:]]
        context = triple[:-1]
        path = np.where(context >= 0, three_four[(np.maximum(context, 0) << 8) + raw[3:]], -1)
        out = self.costs[3][path] if len(self.costs[3]) else np.zeros((len(path), len(self.languages)), np.float32)
        rest = np.flatnonzero(path < 0)
        if len(rest):
            seen, last = context[rest], triple[1:][rest]
            tail = np.where((last >= 0)[:, None], self.costs[2][last], self.escapes[2][pair[1:-1][rest]] + self.costs[1][pair[2:][rest]])
            out[rest] = np.where((seen >= 0)[:, None], self.escapes[3][seen], np.float32(0)) + tail
        return out

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of each text under each language."""
        total = np.zeros((len(texts), len(self.languages)))
        held: list[bytes] = []
        owners: list[int] = []

        def flush() -> None:
            if held:
                bits = self.costs_of(b"".join(held))
                starts = np.cumsum([0, *(len(part) for part in held[:-1])])
                for k in range(ORDER):
                    bits[starts[1:] - ORDER + k] = 0  # the next part's context
                np.add.at(total, owners, np.add.reduceat(bits, starts, axis=0, dtype=np.float64))
                held.clear()
                owners.clear()

        size = 0
        for k, text in enumerate(texts):
            whole = _START + text
            for at in range(0, len(text), SLICE):
                part = whole[at : at + SLICE + ORDER]
                if size + len(part) > SLICE:
                    flush()
                    size = 0
                held.append(part)
                owners.append(k)
                size += len(part)
        flush()
        return total

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        """The language of the shortest code (ties: the first by name) and its share of probability."""
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        bits = self.lengths(texts)
        best = bits.argmin(axis=1)
        share = 1.0 / np.exp2(-np.minimum(bits - bits.min(axis=1, keepdims=True), 1000.0)).sum(axis=1)
        return [self.languages[k] for k in best], share.tolist()


def train(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = SAMPLE_ROWS) -> ContextTrees:
    """Fit the trees on at most ``rows`` texts of each language, those of the smallest hashes of their key.

    Rows without text or language are left out. A language's texts are drawn until they have SAMPLE_BYTES, or its even
    share of MODEL_BYTES, so that one of long texts only is learned as well, from the first of them at least. Only drawn
    texts are shuffled. They are counted by Spark, each as if three line feeds followed it; the driver receives counts of
    different runs of four bytes, of which there are no more than the sample has bytes, and no text. An empty table gives
    trees without languages.
    """
    found = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter("lang is not null")
    sizes = found.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    share = F.least(F.lit(SAMPLE_BYTES), F.floor(F.lit(MODEL_BYTES) / F.count("*").over(Window.partitionBy(F.lit(0)))))  # of LANGUAGES rows at most
    chance = F.broadcast(sizes.select("lang", (F.lit(1.5 * rows) / F.col("count")).alias("chance"), share.alias("share")))
    order = F.xxhash64("key", F.lit("sample"))
    drawn = found.withColumn("order", order).join(chance, "lang").filter(F.pmod("order", F.lit(1 << 30)) < F.col("chance") * (1 << 30))
    own = Window.partitionBy("lang").orderBy("order", "text")
    ranked = drawn.filter(F.col("text").isNotNull()).withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= rows)
    upto = F.sum(F.octet_length("text").cast("long")).over(own.rowsBetween(Window.unboundedPreceding, 0))
    sample = ranked.withColumn("upto", upto).filter((F.col("upto") <= F.col("share")) | (F.col("rank") == 1)).select("lang", "text")
    counted = sample.mapInArrow(_count_batches, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    names, grams, n = (counted[c].to_numpy() for c in ("lang", "gram", "n"))
    languages, which = np.unique(names.astype(str), return_inverse=True)
    ordered = np.lexsort((grams, which))
    bounds = np.searchsorted(which[ordered], np.arange(len(languages) + 1))
    parts = (ordered[a:b] for a, b in zip(bounds, bounds[1:], strict=False))
    return ContextTrees.of_counts({str(name): (grams[p].astype(np.uint32), n[p]) for name, p in zip(languages, parts, strict=True)})


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each language's runs of four bytes, of at most 8 MB of texts, or one longer text, at a time."""
    for batch in batches:
        for part in parts_of(batch, 8 << 20):
            texts: dict[str, list[bytes]] = {}
            for name, value in zip(*(column.to_pylist() for column in part.columns), strict=True):
                texts.setdefault(name, []).append(value.encode())
            for name, own in texts.items():
                grams, n = grams_of(_START + b"".join(text + _START for text in own))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams)), pa.array(grams.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])


def identify(docs: DataFrame, trees: ContextTrees, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key, lang_pred and score (0 to 1) of every whole text.

    Null texts and texts without a letter are ``und`` with score 0, as is everything if no language was learned.
    Repeated rows get equal results; no other column is read.
    """
    model = docs.sparkSession.sparkContext.broadcast(trees)  # bounded by the training sample

    def make() -> Callable:
        own = model.value

        def work(keys: list, texts: list) -> list[list]:
            names, scores = own.predict([b"" if value is None else value.encode() for value in texts])
            known = [value is not None for value in texts]
            return [
                keys,
                [name if ok else UNKNOWN for name, ok in zip(names, known, strict=True)],
                [score if ok else 0.0 for score, ok in zip(scores, known, strict=True)],
            ]

        return work

    lettered = F.when(F.col(text).rlike("\\p{L}"), F.col(text))
    return map_rows(docs.select(F.col(key).cast("long"), lettered), f"`{key}` long, lang_pred string, score double", make)
