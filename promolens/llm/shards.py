"""Sharding by jump consistent hashing: a stable key and the number of shards decide, without a ring table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import mixed, numbered


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key. With one more shard, a key stays or moves into the new one."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = mixed(keys.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    shard = np.zeros(len(state), dtype=np.int64)
    jump = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    while len(live):
        shard[live] = jump[live]
        state[live] = state[live] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        jump[live] = ((shard[live] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        live = live[jump[live] < shards]
    return shard.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Shard of an integer key; a null key counts as 0."""

    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(dtype=np.int64), shards))

    return F.pandas_udf(place, "int")(F.coalesce(key.cast("long"), F.lit(0)))


def shard_documents(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Place every row in a shard by its key and number the rows of a shard from 0 without gaps.

    Returns the key, size (bytes of the text plus 16; null text: 16), text_crc32 (null: of nothing, 0), shard,
    slot and grown_shard, the place with one shard more. Equal rows and equal texts are not held together
    unless their keys agree; repeated keys share a shard and get slots of their own. An empty table gives no
    rows. Texts are never shuffled: only ids, sizes and checksums move.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    placed = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(content) + 16).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        shard_of(F.col(key), shards).alias("shard"),
        shard_of(F.col(key), shards + 1).alias("grown_shard"),
    )
    return numbered(placed, ["shard"], ["key", "text_crc32", "size"], "slot").withColumnRenamed("key", key)


def write_shards(docs: DataFrame, path: str, shards: int = 40, files: int = 64, key: str = "doc_id") -> None:
    """Write all columns of ``docs`` as one folder per shard, each in up to ``files`` files."""
    placed = docs.withColumn("shard", shard_of(F.col(key), shards))
    spread = F.pmod(F.xxhash64(key), F.lit(files))
    placed.repartition("shard", spread).write.partitionBy("shard").parquet(path)
