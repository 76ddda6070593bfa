"""Quality rules: fixed base rules, and thresholds that adapt to language and source by mergeable quantile sketches.

Built-in functions only. A sketch is a histogram over fixed buckets of a measure: rows (group, measure, bucket, count),
merged by adding counts. It is exact to one bucket and gives the same result in whatever order parts are merged.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import stored, words_of

#: Words of a window that counts as repeated.
REPEAT = 8
#: Base rules: fewer words, or a larger percentage of repeated words, fail.
MIN_WORDS, MAX_REPEATED = 20, 30
#: Leading bits of a measure that make its bucket: values below 2048 are buckets of their own, larger ones share one with
#: others up to a thousandth apart. Measures are in thousandths (mean word length in hundredths of characters).
BITS = 11


@dataclass(frozen=True)
class Adaptive:
    """A measure and its threshold in a group: the median plus ``spread`` times the distance from the median to the
    upper quantile, but at least ``floor``; above it a text fails. The floor keeps groups of ordinary texts whole. What is
    ordinary for a ``scripted`` measure depends on the script, so it has no limit from texts of other languages."""

    measure: str
    floor: int
    spread: float = 4.0
    quantile: float = 0.75
    scripted: bool = False


RULES = (
    Adaptive("symbols", floor=50),
    Adaptive("duplicate_lines", floor=400),
    Adaptive("repeated", floor=250),
    Adaptive("stutter", floor=300),
    Adaptive("word_length", floor=1200, scripted=True),
)
_QUANTILES = sorted({rule.quantile for rule in RULES})
#: Groups with fewer texts use their language's thresholds, and those of small languages the whole table's, or for scripted
#: measures none.
MIN_GROUP = 50


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it more than once."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words in windows of REPEAT words that occur twice or more in the text, each word once."""
    size = F.size(words)
    places = F.when(size > REPEAT, F.sequence(F.lit(0), size - REPEAT)).otherwise(F.array().cast("array<int>"))

    def cover(places: Column) -> Column:
        start = F.struct(F.lit(-REPEAT).alias("last"), F.lit(0).alias("n"))
        add = lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(REPEAT), i - a["last"])).alias("n"))
        return F.aggregate(places, start, add, lambda a: a["n"])

    def twice(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda s, e, j: F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False))
        kept = _let(ordered, lambda s: F.filter(s, lambda e, j: same(s, e, j)))
        return cover(F.array_sort(F.transform(kept, lambda e: e["i"])))

    hashes = F.transform(places, lambda i: F.xxhash64(F.slice(words, i + 1, REPEAT)))
    return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(twice(h))).cast("long")


def measured(
    docs: DataFrame, key: str = "doc_id", text: str = "text", groups: tuple[str, str] = ("lang", "source"), also: str | None = None
) -> DataFrame:
    """The key, the groups and the counts of every whole text; a null text has no words. A column ``also`` comes as that.

    Windows are compared by 64-bit hashes of their words, within one text.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    more = [] if also is None else [F.col(also).alias("also")]
    split = docs.select(F.col(key).alias("key"), *more, *(F.col(g).cast("string").alias(n) for g, n in zip(groups, ("lang", "source"), strict=True)), content.alias("content"), words_of(content).alias("words"))
    lines = split.withColumn("lines", F.filter(F.split("content", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    return lines.select(
        "key",
        *(["also"] if more else []),
        "lang",
        "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("content", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        _repeated_words(F.col("words")).alias("n_repeat_words"),
        F.size(F.filter("words", lambda w, i: w == F.coalesce(F.get(F.col("words"), i - 1), F.lit("")))).cast("long").alias("n_same"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def _measures() -> list[Column]:
    share = lambda part, whole, scale=1000: F.floor(F.lit(scale) * F.col(part) / F.greatest(F.col(whole), F.lit(1))).cast("long")
    measures = {
        "symbols": share("n_symbols", "word_chars"),
        "duplicate_lines": share("n_dup_lines", "n_lines"),
        "repeated": share("n_repeat_words", "n_words"),
        "stutter": share("n_same", "n_words"),
        "word_length": share("word_chars", "n_words", 100),
    }
    return [measures[rule.measure].alias(rule.measure) for rule in RULES]


def _bucket(measure: str) -> Column:
    """The smallest value with the same leading bits and as many others."""
    rest = F.greatest(F.lit(0), F.length(F.bin(measure)) - BITS)
    return F.call_function("shiftleft", F.call_function("shiftright", F.col(measure), rest), rest)


def limits(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Merge sketches by the given columns and read the limits off: one row per group, a column for each rule."""
    merged = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "measure")
    upto = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = merged.withColumns({"upto": upto, "texts": F.sum("n").over(group)})
    at = lambda q: F.min(F.when(F.col("upto") >= F.lit(q) * F.col("texts"), F.col("bucket")))
    read = ranked.groupBy(*by, "measure").agg(F.max("texts").alias("texts"), at(0.5).alias("middle"), *(at(q).alias(f"q{k}") for k, q in enumerate(_QUANTILES)))
    columns = []
    for rule in RULES:
        upper = F.col(f"q{_QUANTILES.index(rule.quantile)}")
        fence = F.col("middle") + F.lit(rule.spread) * (upper - F.col("middle"))
        mine = F.when(F.col("measure") == rule.measure, F.greatest(F.lit(float(rule.floor)), fence))
        columns.append(F.max(mine).alias(f"max_{rule.measure}"))
    return read.groupBy(*by).agg(F.max("texts").alias("texts"), *columns)


def judged(measures: DataFrame) -> DataFrame:
    """Add base_failed, the measures, their limits and ``kept`` to measured rows. A scripted measure's limit is null, and
    not judged, in a language of fewer than MIN_GROUP texts.

    Sketches are taken of all texts that pass the base rules. They are summed per task before anything is shuffled,
    so a language or source with most of the rows costs no more than its few thousand buckets. Every text then gets
    the limits of its language and source, or of the wider group where that has fewer than MIN_GROUP texts. Null
    languages and sources are groups like others. ``measures`` is read twice, so it should be stored.
    """
    rows = measures.select("*", base_failed().alias("base_failed"), *_measures())
    measure = F.explode(F.array(*(F.struct(F.lit(r.measure).alias("measure"), _bucket(r.measure).alias("bucket")) for r in RULES)))
    sketch = (
        rows.filter(~F.col("base_failed"))
        .select(F.lit(0).alias("all"), "lang", "source", measure.alias("m"))
        .groupBy("all", "lang", "source", "m.measure", "m.bucket")
        .agg(F.count("*").alias("n"))
    )
    joined = rows.withColumn("all", F.lit(0))
    found: dict[str, list[Column]] = {rule.measure: [] for rule in RULES}
    for level, by in enumerate((["all", "lang", "source"], ["all", "lang"], ["all"])):
        own = limits(sketch, by)
        own = own.filter(F.col("texts") >= MIN_GROUP) if level < 2 else own
        names = {rule.measure: f"limit{level}_{rule.measure}" for rule in RULES}
        own = own.select(*(F.col(b).alias(f"by{level}_{b}") for b in by), *(F.col(f"max_{m}").alias(n) for m, n in names.items()))
        for rule in RULES:
            if level < 2 or not rule.scripted:
                found[rule.measure].append(F.col(names[rule.measure]))
        joined = joined.join(own, reduce(and_, (F.col(b).eqNullSafe(F.col(f"by{level}_{b}")) for b in by)), "left")
    limit = {measure_name: F.coalesce(*columns) for measure_name, columns in found.items()}
    over = reduce(or_, (F.coalesce(F.col(m) > limit[m], F.lit(False)) for m in limit))
    return joined.select(*rows.columns, *(limit[m].alias(f"max_{m}") for m in limit), (~F.col("base_failed") & ~over).alias("kept"))


def assess(
    docs: DataFrame, key: str = "doc_id", text: str = "text", groups: tuple[str, str] = ("lang", "source"), also: str | None = None
) -> DataFrame:
    """Measures and verdict of every row; the key comes as ``key``. Repeated rows are judged each; an empty table gives
    no rows; other columns are not read. Measures are stored between the two readings."""
    return judged(stored(measured(docs, key, text, groups, also)))
