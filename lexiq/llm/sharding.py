"""Sharding: jump consistent hashing from stable keys to shards.

``jump`` maps a 64-bit key to one of n shards without a table; with n + 1 shards a key either
stays or moves into the new shard, and about 1 / (n + 1) of the keys move. The law is ``key``:
the id and the shard count alone decide, so equal texts with different ids may part.

Rows are range-partitioned by (shard, key): a shard is a run of sorted files, so a hot shard is
many tasks, and a row's slot in its shard is its place in its file plus the rows in the shard's
earlier files (one number per file and shard).

A null id is a key of its own; null text counts no bytes. Equal keys are ordered by text. An
empty table gives no rows. Extra columns are written along; columns named like an output column
are replaced by it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import new_table_path
from . import words as W
from .common import documents, small, stored, without

N_SHARDS = 16
#: The multiplier and the scale of the published jump hash.
MULTIPLIER, SCALE, SHIFT = 2862933555777941757, 1 << 31, 33
_NULL_KEY = -(1 << 63)


def jump(keys: np.ndarray, n: int) -> np.ndarray:
    """Shard 0..n-1 of every unsigned 64-bit key. Each step jumps ahead; about log(n) steps."""
    key, shard, ahead = keys.astype(np.uint64), np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
    live = np.arange(len(keys))
    while len(live):
        shard[live] = ahead[live]
        key[live] = key[live] * np.uint64(MULTIPLIER) + np.uint64(1)
        draw = (key[live] >> np.uint64(SHIFT)).astype(np.float64) + 1.0
        ahead[live] = ((shard[live] + 1).astype(np.float64) * (SCALE / draw)).astype(np.int64)
        live = live[ahead[live] < n]
    return shard.astype(np.int32)


def shard_of(key: Column, n: int) -> Column:
    @F.pandas_udf("int")
    def run(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(W.mix(keys.to_numpy(np.int64).view(np.uint64)), n))

    return run(F.coalesce(key.cast("long"), F.lit(_NULL_KEY)))


def write_shards(docs: DataFrame, path: str, n: int = N_SHARDS, key: str = "doc_id", text: str = "text") -> None:
    """Write ``docs`` as folders ``shard=K`` of sorted files; ``place`` ascends within a file."""
    assert n >= 1, "at least one shard"
    placed = (without(docs, ["shard", "grown_shard", "place", "slot", "law"])
              .withColumn("shard", shard_of(F.col(f"`{key}`"), n))
              .withColumn("grown_shard", shard_of(F.col(f"`{key}`"), n + 1)))
    order = ["shard", f"`{key}`", F.crc32(F.col(f"`{text}`").cast("binary")), F.col(f"`{text}`")]
    (placed.repartitionByRange(*order[:3]).sortWithinPartitions(*order)
     .withColumn("place", F.monotonically_increasing_id())
     .write.partitionBy("shard").option("compression", "zstd").parquet(path))


def read_shards(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The rows of the shard files with ``slot``, gapless from 0 in every shard."""
    rows = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    part = F.shiftright("place", SHIFT)
    files = rows.groupBy("shard", part.alias("part")).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = stored(files.select("shard", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first"))
                                .alias("_shift")), "shards")
    return (rows.withColumn("part", part).join(small(files), ["shard", "part"])
            .withColumn("slot", F.col("place") + F.col("_shift")).drop("part", "place", "_shift"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_table_path(spark, "sharded")
    write_shards(documents(spark, sf_dir).select("doc_id", "text"), path)
    rows = read_shards(spark, path, "doc_id long, text string, grown_shard int, place long, shard int")
    text = F.coalesce("text", F.lit(""))
    return rows.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
                       "shard", "slot", "grown_shard")
