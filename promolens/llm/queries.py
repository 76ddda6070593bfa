"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm import bpe, codes, languages, licenses, negatives, packing, pseudonyms, quality, shards, simhash, substrings, vectors, warc
from promolens.llm.common import checkpoint_folder, ship_package, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: For the test tables only; real data need a secret key.
PSEUDONYM_KEY = b"test tables"


def query(function: Query) -> Query:
    @wraps(function)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = shipped
    return shipped


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.token_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op2_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.shard_documents(table(spark, sf_dir, "documents"), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"))


@query
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query
def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


@query
def op6_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    trees = languages.train(docs.filter(fold != 1))
    own = languages.identify(docs, trees)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return own.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packing.packed_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, end_id=1)


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.assess(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select("doc_id", *counts, "base_failed", "kept")


@query
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = checkpoint_folder(spark)
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = codes.compress(table(spark, sf_dir, "embeddings"))
    return done.with_label_errors().select(F.col("key").alias("vec_id"), "code", "error", "label_error", F.lit(done.digest).alias("codebooks_sha256"))


@query
def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    mined = negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=label)
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
