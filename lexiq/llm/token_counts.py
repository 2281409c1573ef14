"""Token counts: an exact histogram of encoded document lengths.

Every task counts the lengths of its documents, so only (length, number) pairs are shuffled.
Sums over the histogram answer, for every context limit, how many documents exceed it, how many
tokens remain when documents are cut to it, and which share of documents fits. The running sums
are taken in two steps, over blocks of ``BLOCK`` lengths and inside each block, so that no task
reads the whole histogram.

Null and empty texts have length 0. An empty table has an empty histogram. Repeated rows count
each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import words as W
from .common import documents, stored
from .tokens import encoder

BLOCK = 1024


def length_histogram(docs: DataFrame, tokenizer_path: str, text: str = "text") -> DataFrame:
    """(length, n_docs) for every encoded length that occurs."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1, np.int64)
        for batch in batches:
            for w in W.slices(batch.column(0)):
                now = np.bincount(encoder(tokenizer_path).lengths(w))
                if len(now) > len(seen):
                    seen, now = now, seen
                seen[:len(now)] += now
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["length", "n_docs"])

    return (docs.select(F.col(text)).mapInArrow(counted, "length long, n_docs long")
            .groupBy("length").agg(F.sum("n_docs").alias("n_docs")))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For every length that occurs, taken as the context limit: ``n_docs`` of that length,
    ``n_docs_over`` and ``tokens_over`` of longer documents, ``tokens_truncated`` when longer
    documents are cut to the limit, ``tokens_total`` and the ``share_within`` of documents that fit."""
    h = stored(histogram, "lengths").withColumn("block", F.floor(F.col("length") / BLOCK))
    tokens = F.col("length") * F.col("n_docs")
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("docs"), F.sum(tokens).alias("tokens"))
    # one row per BLOCK lengths: as many rows as the longest document has thousands of tokens
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select("block", F.coalesce(F.sum("docs").over(later), F.lit(0)).alias("docs_later"),
                           F.coalesce(F.sum("tokens").over(later), F.lit(0)).alias("tokens_later"),
                           F.sum("docs").over(every).alias("docs_total"),
                           F.sum("tokens").over(every).alias("tokens_total"))
    longer = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    x = h.join(blocks, "block").select(
        "length", "n_docs", "docs_total", "tokens_total",
        (F.coalesce(F.sum("n_docs").over(longer), F.lit(0)) + F.col("docs_later")).alias("n_docs_over"),
        (F.coalesce(F.sum(tokens).over(longer), F.lit(0)) + F.col("tokens_later")).alias("tokens_over"))
    return x.select(
        F.col("length").alias("context_limit"), "n_docs", "n_docs_over", "tokens_over",
        (F.col("tokens_total") - F.col("tokens_over") + F.col("length") * F.col("n_docs_over")).alias("tokens_truncated"),
        "tokens_total", (1 - F.col("n_docs_over") / F.col("docs_total")).alias("share_within"))


def quantile(sums: DataFrame, q: float) -> DataFrame:
    """The smallest length that at least a share ``q`` of the documents does not exceed."""
    return sums.filter(F.col("share_within") >= q).agg(F.min("context_limit").alias("length"))


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """Tokens left when every document is cut to ``limit``, for any limit."""
    return histogram.agg(F.coalesce(F.sum(F.least("length", F.lit(limit)) * F.col("n_docs")), F.lit(0)).alias("tokens"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return suffix_sums(length_histogram(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")))
