"""Substring dedup: repeated windows of words are found with compressed FM-indexes, one per shard of shared passages.

1. Every window of WINDOW words has an anchor, the smallest hash of the GRAM-word grams in it, so equal windows have
   equal anchors. Consecutive windows of one anchor make a run. Anchors that occur under one key only are dropped.
2. The remaining runs are dealt to shards by their anchor, equal runs once per task with their smallest key.
3. Each shard's runs are indexed; all windows are streamed against the index by backward search, which gives the
   interval of suffixes that begin with the window, and so the smallest key that has it.
4. Each document's runs are joined to these answers, and words of windows with a smaller key are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import fresh, mixed, stored, word_hashes, word_spans

WINDOW, GRAM = 13, 4
#: Bits of the filter of shared anchors that every task gets: 16 MB. Beyond a hundred million shared anchors it lets
#: more and more runs pass that no other document has; they cost work, and change no result.
FILTER_BITS = 27
#: An anchor in more documents than this, and in more than one of HOT_SHARE, is hot: its runs are cut into single
#: windows, dealt by the window's own hash. There are at most HOT_SHARE times the mean anchors per document of them.
HOT, HOT_SHARE = 20_000, 5_000
#: Words that are indexed together, at the least; a shard's anchors are never parted.
INDEX_WORDS = 250_000
_MULTIPLIER = 0xD1342543DE82EF95


@dataclass
class Runs:
    """Runs of windows of one text: the shard key, the content's hash, the first window and how many there are."""

    key: np.ndarray
    content: np.ndarray
    first: np.ndarray
    count: np.ndarray


def _content_hashes(words: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    n = len(words) + 1
    up = np.full(n, _MULTIPLIER, dtype=np.uint64)
    down = np.full(n, pow(_MULTIPLIER, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    sums = np.zeros(n, dtype=np.uint64)
    np.cumsum(words * np.multiply.accumulate(up)[:-1], out=sums[1:], dtype=np.uint64)
    own = (sums[first + count + WINDOW - 1] - sums[first]) * np.multiply.accumulate(down)[first]
    return mixed(own ^ mixed(count.astype(np.uint64)))


def anchors_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first window and number of windows of each run of a text's word hashes."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    grams = np.zeros(len(words) - GRAM + 1, dtype=np.uint64)
    for k in range(GRAM):
        grams = mixed(grams + words[k : k + len(grams)])
    owner = sliding_window_view(grams, WINDOW - GRAM + 1).argmin(axis=1) + np.arange(n)
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    return grams[owner[first]], first, np.diff(np.append(first, n))


def _slot(anchor: np.ndarray) -> np.ndarray:
    """31 bits that stand for an anchor while shared ones are counted."""
    return (anchor >> np.uint64(33)).astype(np.int64)


@dataclass
class Shared:
    """A filter of anchors that occur under several keys, and the hot ones among them."""

    bits: np.ndarray
    hot: np.ndarray

    def runs(self, words: np.ndarray) -> Runs:
        anchor, first, count = anchors_of(words)
        slot = _slot(anchor)
        bit = slot >> (31 - FILTER_BITS)
        kept = self.bits[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1) > 0
        anchor, first, count, slot = anchor[kept], first[kept], count[kept], slot[kept]
        hot = np.isin(slot, self.hot) if len(self.hot) else np.zeros(len(slot), bool)
        if hot.any():
            single = np.repeat(first[hot], count[hot]) + np.concatenate([np.arange(c) for c in count[hot]])
            first, count = np.concatenate([first[~hot], single]), np.concatenate([count[~hot], np.ones(len(single), np.int64)])
            content = _content_hashes(words, first, count)
            key = np.concatenate([anchor[~hot], content[int((~hot).sum()) :]])
        else:
            content, key = _content_hashes(words, first, count), anchor
        return Runs(key.view(np.int64), content.view(np.int64), first, count)


class WaveletMatrix:
    """Rank of symbols in a sequence, from one plain bit vector per bit of the symbols."""

    def __init__(self, sequence: np.ndarray, symbols: int) -> None:
        self.depth = max(1, int(symbols - 1).bit_length())
        self.words: list[np.ndarray] = []
        self.sums: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(self.depth - 1, -1, -1):
            bit = (sequence >> level & 1).astype(bool)
            padded = np.zeros((len(bit) // 64 + 1) * 64, dtype=bool)
            padded[: len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(words)
            self.sums.append(np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1])))
            self.zeros.append(len(bit) - int(bit.sum()))
            sequence = np.concatenate([sequence[~bit], sequence[bit]])
        self.begin = np.zeros(symbols, dtype=np.int64)
        self.begin = self._walk(np.arange(symbols), np.zeros(symbols, dtype=np.int64))

    def _walk(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for level, words, sums, zeros in zip(range(self.depth - 1, -1, -1), self.words, self.sums, self.zeros, strict=True):
            block = place >> 6
            below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
            ones = sums[block] + np.bitwise_count(words[block] & below)
            place = np.where(symbol >> level & 1, zeros + ones, place - ones)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``place``."""
        return self._walk(symbol, place) - self.begin[symbol]


class FmIndex:
    """A text of integer symbols, searched backwards for patterns of up to ``depth`` symbols.

    Suffixes are ordered by their first ``depth`` symbols only, which is all that such patterns can tell apart.
    """

    def __init__(self, text: np.ndarray, symbols: int, depth: int = WINDOW) -> None:
        self.order, self.group = self._sorted(text, depth)
        self.index = WaveletMatrix(text[self.order - 1], symbols)
        self.counts = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))

    @staticmethod
    def _sorted(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Places in the order of their suffixes, and where in that order the prefix of ``depth`` symbols changes."""
        rank, width = text.astype(np.int64), 1
        while width < depth:
            step = min(width, depth - width)
            ahead = np.concatenate([rank[step:], np.zeros(step, np.int64)])
            joined = rank * (int(rank.max(initial=0)) + 1) + ahead
            width += step
            if width < depth:
                rank = np.unique(joined, return_inverse=True)[1]
        order = np.argsort(joined, kind="stable")
        ordered = joined[order]
        return order, np.concatenate(([True], ordered[1:] != ordered[:-1]))

    def search(self, text: np.ndarray, begins: np.ndarray, depth: int = WINDOW) -> np.ndarray:
        """Where the interval of suffixes that begin with ``text[b : b + depth]`` starts, for windows of the indexed text.

        A window whose interval has one suffix left is nowhere else; its search ends there, with -1.
        """
        out = np.full(len(begins), -1, dtype=np.int64)
        for at in range(0, len(begins), 1 << 15):
            live = np.arange(at, min(at + (1 << 15), len(begins)))
            last = text[begins[live] + depth - 1]
            low, high = self.counts[last], self.counts[last + 1]
            for k in range(depth - 2, -1, -1):
                more = high - low > 1
                live, low, high = live[more], low[more], high[more]
                symbol = text[begins[live] + k]
                ranks = self.index.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
                low, high = self.counts[symbol] + ranks[: len(live)], self.counts[symbol] + ranks[len(live) :]
            more = high - low > 1
            out[live[more]] = low[more]
        return out


def smallest_keys(low: np.ndarray, texts: list[bytes]) -> list[np.ndarray]:
    """For each window of each run: the smallest ``low`` of the runs of this shard that have the same words."""
    data = b" ".join(texts)
    begin, end = word_spans(data)
    edges = np.cumsum([0, *(len(t) + 1 for t in texts)])
    sizes = np.diff(np.searchsorted(begin, edges))
    words = np.unique(word_hashes(data, begin, end), return_inverse=True)
    run = np.repeat(np.arange(len(texts)), sizes)
    text = np.zeros(len(run) + len(texts), dtype=np.int64)
    place = np.arange(len(run)) + run  # a separator, symbol 0, ends each run
    text[place] = words[1] + 1
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    index = FmIndex(text, len(words[0]) + 1)
    windows = np.maximum(sizes - WINDOW + 1, 0)
    starts = np.cumsum(np.concatenate(([0], sizes[:-1] + 1)))
    run_of = np.repeat(np.arange(len(texts)), windows)
    begins = np.repeat(starts, windows) + np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    found = index.search(text, begins)
    least = low[run_of].copy()
    groups = np.flatnonzero(index.group)
    by_group = np.minimum.reduceat(low[owner[index.order]], groups)
    hit = found >= 0
    least[hit] = by_group[np.searchsorted(groups, found[hit], side="right") - 1]
    return np.split(least, np.cumsum(windows)[:-1])


def _batches(batch: pa.RecordBatch, rows: int = 2000) -> Iterator[tuple[list, list]]:
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        yield part.column(0).to_pylist(), part.column(1).to_pylist()


def _hashed(text: str) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    data = text.encode()
    begin, end = word_spans(data)
    return data, begin, end, word_hashes(data, begin, end)


def _record(names: list[str], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def shared_anchors(texts: DataFrame) -> Shared:
    """Find the anchors under several keys: a filter of fixed size and the few hot ones, which the driver passes on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, values in _batches(batch):
                slots = [np.unique(_slot(anchors_of(_hashed(value)[3])[0])) for value in values]
                sizes = [len(s) for s in slots]
                if sum(sizes):
                    yield _record(["slot", "key"], [np.concatenate(slots), np.repeat(np.array(keys, np.int64), sizes)])

    found = texts.mapInArrow(run, "slot long, key long").groupBy("slot").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n"))
    shared = stored(found.filter(F.col("low") < F.col("high")).select("slot", "n"))
    bit = F.shiftright("slot", 31 - FILTER_BITS)
    words = shared.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))).alias("bits")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    crowded = shared.filter(F.col("n") > HOT)
    most = crowded.agg(F.sum("n")).first()[0] or 0
    hot = crowded.filter(F.col("n") > most // HOT_SHARE).select("slot").toArrow().column("slot").to_numpy()
    return Shared(bits.view(np.uint64), hot)


def window_answers(texts: DataFrame, shared: Shared) -> DataFrame:
    """For each content of a run that is elsewhere too: the smallest key of each of its windows, ``least``."""
    given = texts.sparkSession.sparkContext.broadcast(shared)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, values in _batches(batch, batch.num_rows):  # as many as there are, so that equal runs meet
                parts, slices, lows = [], [], []
                for key, value in zip(keys, values, strict=True):
                    data, begin, end, words = _hashed(value)
                    runs = given.value.runs(words)
                    parts.append(np.stack([runs.key, runs.content]))
                    lows.append(np.full(len(runs.key), key, dtype=np.int64))
                    last = runs.first + runs.count + WINDOW - 2
                    slices += [(data, a, b) for a, b in zip(begin[runs.first].tolist(), end[last].tolist(), strict=True)] if len(runs.key) else []
                if not slices:
                    continue
                ids, low = np.concatenate(parts, axis=1), np.concatenate(lows)
                order = np.lexsort((low, ids[1], ids[0]))
                ids, low = ids[:, order], low[order]
                new = np.concatenate(([True], (ids[:, 1:] != ids[:, :-1]).any(axis=0)))
                starts = np.flatnonzero(new)
                bodies = [slices[k][0][slices[k][1] : slices[k][2]] for k in order[starts].tolist()]
                yield _record(["key", "content", "low", "high", "body"], [ids[0, starts], ids[1, starts], low[starts], np.maximum.reduceat(low, starts), bodies])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
            if not table.num_rows:
                return
            key, content, low, high = (table.column(k).to_numpy() for k in range(4))
            starts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (content[1:] != content[:-1]))))
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            least = smallest_keys(low, table.column(4).take(pa.array(starts)).to_pylist())
            some = [k for k, x in enumerate(least) if (x < high[k]).any()]
            if some:
                chosen = starts[some]
                yield _record(["key", "content", "least"], [key[chosen], content[chosen], [least[k] for k in some]])

        for batch in batches:
            held.append(batch)
            size += batch.column(4).nbytes
            if size > INDEX_WORDS * 6:
                table = pa.Table.from_batches(held).combine_chunks()
                key = table.column(0).to_numpy()
                cut = int(np.searchsorted(key, key[-1]))
                yield from solve(table.slice(0, cut))
                rest = table.slice(cut).combine_chunks()
                held, size = rest.to_batches(), 0 if cut else size
        if held:
            yield from solve(pa.Table.from_batches(held).combine_chunks())

    runs = texts.mapInArrow(collect, "key long, content long, low long, high long, body binary")
    dealt = runs.repartition("key").sortWithinPartitions("key", "content")
    return dealt.mapInArrow(answer, "key long, content long, least array<long>")


def repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """First words of the windows that also start in a text with a smaller key: (key, text_hash, windows), only rows that
    have any. ``text_hash`` (Spark's xxhash64 of the text) tells rows of one key apart."""
    texts = docs.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    shared = shared_anchors(texts)
    answers = window_answers(texts, shared)
    given = texts.sparkSession.sparkContext.broadcast(shared)

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                runs = [given.value.runs(_hashed(value)[3]) for value in part.column(1).to_pylist()]
                sizes = [len(r.key) for r in runs]
                if sum(sizes):
                    own = [np.repeat(part.column(c).to_numpy(), sizes) for c in (0, 2)]
                    yield _record(["owner", "text_hash", "key", "content", "first"], [*own, *(np.concatenate([getattr(r, n) for r in runs]) for n in ("key", "content", "first"))])

    places = texts.withColumn("text_hash", F.xxhash64("text")).mapInArrow(occurrences, "owner long, text_hash long, key long, content long, first long")
    windows = F.filter(F.transform("least", lambda x, j: F.when(x < F.col("owner"), (F.col("first") + j).cast("int"))), lambda x: x.isNotNull())
    hits = places.join(answers, ["key", "content"]).select(F.col("owner").alias("key"), "text_hash", windows.alias("windows")).filter(F.size("windows") > 0)
    return hits.groupBy("key", "text_hash").agg(F.array_distinct(F.flatten(F.collect_list("windows"))).alias("windows"))


def marked(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` and, last, the repeated windows' first words (null without any)."""
    name, content, windows = (fresh(docs, n) for n in ("found_key", "found_hash", "windows"))
    found = repeated_windows(docs, key, text).select(F.col("key").alias(name), F.col("text_hash").alias(content), F.col("windows").alias(windows))
    own = (F.col(key).cast("long") == F.col(name)) & (F.xxhash64(text) == F.col(content))
    return docs.join(found, own, "left").drop(name, content)


def covered(words: int, windows: list[int] | None) -> np.ndarray:
    """Which of so many words lie in the windows."""
    steps = np.zeros(words + 1, dtype=np.int64)
    if windows is not None and len(windows):
        first = np.asarray(windows)
        np.add.at(steps, first, 1)
        np.add.at(steps, first + WINDOW, -1)
    return np.cumsum(steps)[:-1] > 0


def cut(text: str | None, windows: list[int] | None) -> str | None:
    """The text without the words of the windows; what stands between words goes with the word before it."""
    if text is None or windows is None:
        return text
    data = text.encode()
    begin, end = word_spans(data)
    gone = covered(len(begin), windows)
    turns = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
    edges = np.append(begin, len(data))
    out, at = [], 0
    for a, b in zip(turns[0::2].tolist(), turns[1::2].tolist(), strict=True):
        out.append(data[at : edges[a]])
        at = edges[b]
    out.append(data[at:])
    return b"".join(out).decode()


def _scalar(function: Callable, kind: str) -> Callable[..., Column]:
    def run(texts: pd.Series, windows: pd.Series) -> pd.Series:
        return pd.Series([function(t, w) for t, w in zip(texts, windows, strict=True)], dtype=object)

    return F.pandas_udf(run, kind)


def remove_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs``, the text without repeated windows.

    Words stand between ASCII white space. A window is WINDOW words of one text; it goes if the same words also start in
    a text with a smaller key, judged on the input. Null texts stay null, null keys keep their text and count for no
    other; rows of one key are not held against each other; shorter texts have no windows.
    """
    rows = marked(docs, key, text)
    return rows.withColumn(text, _scalar(cut, "string")(F.col(text), F.col(rows.columns[-1]))).drop(rows.columns[-1])


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key, n_words, n_removed and the SHA-256 of the kept words joined by blanks, of every row."""

    def digest(value: str | None, windows: list[int] | None) -> str:
        words = (value or "").encode().split()
        gone = covered(len(words), windows)
        kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if windows is not None else words
        return f"{len(words)} {len(words) - len(kept)} {hashlib.sha256(b' '.join(kept)).hexdigest()}"

    rows = marked(docs.select(key, text), key, text)
    parts = F.split(_scalar(digest, "string")(F.col(text), F.col(rows.columns[-1])), " ")
    done = rows.select(F.col(key), parts.alias("parts"))
    return done.select(key, F.col("parts")[0].cast("long").alias("n_words"), F.col("parts")[1].cast("long").alias("n_removed"), F.col("parts")[2].alias("kept_sha256"))
