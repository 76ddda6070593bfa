"""Distinct customers that can be added up: sets of numbered customers as words of 64 bits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.schemas import OUTLET, PROMO_KEYS

CODE, NUMBER = "LoyaltyCode", "number"
#: Customers to a word.
WORD = 64


def number_customers(rollup: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """A dictionary: each ``LoyaltyCode`` with a ``number`` of its own; rows without a code are left out.

    Customers are numbered in the order of the first outlet they bought at, so that those of a promotion, who mostly
    share an outlet, share words. One distributed sort numbers them: ids run on within a task's rows and skip between
    tasks. Codes of a ``known`` dictionary keep their numbers and are part of the result; new ones come after them, so sets
    made with the old dictionary stay right. Starts a job if one is given. Store the result before it is used: it must not
    be numbered twice.
    """
    homes = rollup.filter(F.col(CODE).isNotNull()).groupBy(CODE).agg(F.min(OUTLET).alias("home"))
    if known is None:
        return _numbered(homes, 0)
    last = known.agg(F.max(NUMBER)).first()[0]
    begin = 0 if last is None else (last // WORD + 1) * WORD
    return known.select(CODE, NUMBER).unionByName(_numbered(homes.join(known, CODE, "left_anti"), begin))


def _numbered(homes: DataFrame, begin: int) -> DataFrame:
    return homes.orderBy("home", CODE).select(CODE, (F.monotonically_increasing_id() + F.lit(begin)).alias(NUMBER))


def customer_sets(rollup: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The customers of every promotion and period: one row per ``word`` of 64 numbers, of which ``bits`` are the members.

    A promotion has at most as many rows as customers, and a sixty-fourth of them where its customers are neighbours. The
    join is on the customer; where one has very many rows, adaptive execution splits them, since the words are put
    together by other keys.
    """
    numbered = rollup.join(dictionary, CODE)
    word, bit = F.shiftright(NUMBER, 6).alias("word"), F.expr(f"shiftleft(1L, CAST({NUMBER} & {WORD - 1} AS INT))")
    return numbered.groupBy(*PROMO_KEYS, "period", word).agg(F.bit_or(bit).alias("bits"))


def merge_sets(*sets: DataFrame) -> DataFrame:
    """The union of sets made with one dictionary or later states of it, in any order; a set merged twice changes nothing."""
    return reduce(DataFrame.unionByName, sets).groupBy(*PROMO_KEYS, "period", "word").agg(F.bit_or("bits").alias("bits"))


def distinct_customers(sets: DataFrame, levels: Sequence[Sequence[str]]) -> DataFrame:
    """Exact distinct ``customers`` of each group of each level, a customer of several promotions counted once.

    A level is a list of columns, an empty one everything. ``level`` names it, its columns joined by commas or ``all``, and
    columns that it does not have are null. All levels are made in one aggregation of the sets: words are first combined
    in each group, in part before the shuffle, and then their bits are counted. No transaction is read.
    """
    names = list(dict.fromkeys(name for level in levels for name in level))
    labels = {tuple(name in level for name in names): ",".join(level) or "all" for level in levels}
    if len(labels) < len(levels):
        raise ValueError(f"a level is named twice: {levels}")
    words = sets.groupingSets([[*level, "word"] for level in levels], *names, "word").agg(
        F.bit_or("bits").alias("bits"), *(F.grouping(name).alias(f"_{k}") for k, name in enumerate(names))
    )
    label = F.coalesce(
        *(
            F.when(reduce(lambda a, b: a & b, (F.col(f"_{k}") == int(not has) for k, has in enumerate(held)), F.lit(True)), text)
            for held, text in labels.items()
        )
    )
    return words.withColumns({"level": label}).groupBy("level", *names).agg(F.sum(F.bit_count("bits")).alias("customers"))
