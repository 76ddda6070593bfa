"""A corpus pipeline: each stage calls one operator of ``promolens.llm`` on all that the stage before it kept.

Stages take and return whole tables with the columns of ``documents``; only the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm import bpe, packing, pseudonyms, quality, simhash, substrings
from promolens.llm.common import fresh, ship_package, stored, table
from promolens.llm.queries import PSEUDONYM_KEY


def _with_length(docs: DataFrame) -> DataFrame:
    """Keep n_chars true to the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the limits of their language and source; null texts go."""
    content, name, kept = (fresh(docs, n) for n in ("content_hash", "kept_key", "kept_hash"))
    hashed = docs.withColumn(content, F.xxhash64("text"))
    verdict = quality.assess(hashed, also=content).filter("kept").select(F.col("key").alias(name), F.col("also").alias(kept)).distinct()
    own = F.col("doc_id").eqNullSafe(F.col(name)) & (F.col(content) == F.col(kept))
    return hashed.join(verdict, own, "left_semi").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles link at three differing bits or fewer.

    That of the smallest doc_id stays, null ids last; null and empty texts are one group, and of repeated rows one stays.
    """
    return simhash.one_of_each_group(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 13 words that also start in a document with a smaller id are cut out of the text."""
    return _with_length(substrings.remove_repeated(docs)).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values in the text become pseudonyms of the same format."""
    masked = pseudonyms.pseudonymise(docs, PSEUDONYM_KEY, kinds=fresh(docs, "kinds"), count=fresh(docs, "found"))
    return _with_length(masked).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their token ids, and their places in sequences of at most 2048."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packing.pack_documents(docs, ranks, public_tokenizers.PATTERN, end_id=1)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _shipped(stage: Stage) -> Stage:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", _shipped(quality_rules)),
    ("near_dedup", _shipped(near_dedup)),
    ("substring_dedup", _shipped(substring_dedup)),
    ("personal_data", _shipped(personal_data)),
    ("packing", _shipped(pack)),
]

#: Fingerprints, pseudonyms and tokens cannot be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
