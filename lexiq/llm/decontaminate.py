"""Benchmark decontamination by SimHash windows, with DataFrame operations only.

Words are lower-cased; a shingle is ``SHINGLE`` words, as a 64-bit hash. A document holds an item if
some window of as many words as the item has, or the whole document if it has fewer, reaches a
weighted shingle similarity of ``THRESHOLD``: each shingle weighs as often as it occurs, and the similarity is the sum of the
smaller weights over the sum of the larger ones.

1. Screen. A window of s shingles similar to an item of m >= s shares at least ``t (s + m) / (1 + t)``
   shingles with it (so ``s >= t m``), thus at most ``floor((1 - t) s / (1 + t))`` of its own are not the
   item's, and one of its shingles at every ``stride``-th place of the document is an item's. Only
   documents with such a shingle go on.
2. Windows. In those documents every item-sized window around an item shingle, or the whole of a
   document shorter than the item, in which enough shingles are item shingles gets a 64-bit SimHash
   over its words.
3. Multi-index. Fingerprints are cut into ``RADIUS + 1`` blocks of bits. Two fingerprints within
   the radius agree in a block, so the join on (item size, block, bits) finds all of them.
4. Check. For every candidate the weighted similarity of window and item is computed exactly.

The benchmark's tables are broadcast only if their counted rows are few. No step groups by a
document's or an item's matches beyond one document's windows. Items of fewer than
``SHINGLE`` words have no shingle and match nothing; so do null and empty texts. Items with the
same text are found each. Rows that repeat id and text are found once; a null id is an id of its
own. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, few, small, stored

WORD = r"[^\x20\x09-\x0D]+"
SHINGLE, THRESHOLD, RADIUS, STRIDE = 5, 0.8, 20, 4
FIELDS, FIELD_BITS = 3, 20


def word_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0)),
                       lambda w: F.xxhash64(w))


def shingles(hashes: str, stride: int = 1) -> Column:
    """Hashes of the shingles that start at every ``stride``-th word."""
    starts = F.when(F.size(hashes) >= SHINGLE, F.sequence(F.lit(0), F.size(hashes) - SHINGLE, F.lit(stride)))
    return F.transform(F.coalesce(starts, F.array().cast("array<int>")),
                       lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(SHINGLE)]))


def most_missing(m: int) -> int:
    """Item shingles that a window of m shingles may lack."""
    return math.floor((1 - THRESHOLD) * m / (1 + THRESHOLD) + 1e-9)


def safe_stride(least: int) -> int:
    """The largest stride up to STRIDE at which a window of ``least`` shingles or more has more
    places than it may lack: floor(m / s) > (1 - t) m / (1 + t) for all m >= least."""
    for s in range(STRIDE, 1, -1):
        if all(m // s > most_missing(m) for m in range(least, max(least, 10 * STRIDE) + 1)):
            return s
    return 1


def simhash(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, fp): SimHash of the word hashes ``h`` of each key. The 64 counters of ones are packed,
    FIELDS to a long, so that a window costs 22 sums; a window has fewer than 2 ** FIELD_BITS words."""
    def packed(first: int) -> Column:
        parts = [F.shiftleft(F.shiftrightunsigned("h", first + f).bitwiseAND(F.lit(1).cast("long")), FIELD_BITS * f)
                 for f in range(FIELDS) if first + f < 64]
        return sum(parts[1:], parts[0])

    sums = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("ones"), *[
        F.sum(packed(b)).alias(f"s{b}") for b in range(0, 64, FIELDS)])
    bits = None
    for b in range(64):
        count = F.shiftrightunsigned(f"s{b - b % FIELDS}", FIELD_BITS * (b % FIELDS)).bitwiseAND(
            F.lit((1 << FIELD_BITS) - 1).cast("long"))
        bit = F.shiftleft(F.when(2 * count > F.col("ones"), 1).otherwise(0).cast("long"), b)
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return sums.select(*keys, bits.alias("fp"))


def blocks(fp: str) -> Column:
    """RADIUS + 1 structs (block, bits) that cover the 64 bits."""
    edges = [64 * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fp, lo).bitwiseAND(
        F.lit((1 << (hi - lo)) - 1).cast("long")).alias("bits")) for i, (lo, hi) in enumerate(zip(edges, edges[1:]))])


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, hamming, window_start, window_words, n_windows): for every document
    of ``docs`` (doc_id, text) and every item of ``items`` (item_id, text) it holds, the best window."""
    item = stored(items.select("item_id", word_hashes(F.col("text")).alias("h"))
                  .filter(F.size("h") >= SHINGLE).dropDuplicates()
                  .withColumn("item", F.monotonically_increasing_id()).withColumn("w", F.size("h")), "items", 1)
    spread = item.select("item", "w", F.explode(shingles("h")).alias("sh"))
    counted = stored(spread.groupBy("item", "w", "sh").agg(F.count(F.lit(1)).alias("n_item")), "item_shingles", 1)
    known, sized = counted.select("sh").distinct(), counted.select("sh", "w").distinct()
    least, longest = item.agg(F.min("w"), F.max("w")).first()
    if longest is not None and longest >= 1 << FIELD_BITS:
        raise ValueError(f"an item has {longest} words; its windows' counters hold fewer than {1 << FIELD_BITS}")
    # a document shorter than the item has THRESHOLD of its shingles or more
    stride = safe_stride(math.ceil(THRESHOLD * ((least or SHINGLE) - SHINGLE + 1) - 1e-9))

    # 1. screen
    rows = docs.select("doc_id", "text")
    hit = (rows.select("doc_id", word_hashes(F.col("text")).alias("h"))
           .select("doc_id", F.explode(shingles("h", stride)).alias("sh"))
           .join(small(known), "sh").select(F.col("doc_id").alias("_hit")).distinct())
    hit = stored(hit, "hit", 1)
    near = stored(rows.join(small(hit), F.col("doc_id").eqNullSafe(F.col("_hit")))
                  .select("doc_id", F.xxhash64("text").alias("key"), word_hashes(F.col("text")).alias("h"))
                  .dropDuplicates(["doc_id", "key"]).withColumn("doc", F.monotonically_increasing_id())
                  .withColumn("n", F.size("h")), "screened")

    # 2. windows in which enough shingles are item shingles
    at = near.select("doc", "n", F.posexplode(shingles("h")).alias("pos", "sh"))
    # w is the item's size; a window has ``size`` words, fewer than w if the document is shorter
    last = F.greatest(F.lit(0), F.col("n") - F.col("w"))
    starts = (at.join(small(sized), "sh").withColumn("size", F.least("w", "n"))
              .select("doc", "w", "size", F.explode(F.sequence(
                  F.greatest(F.lit(0), F.col("pos") - (F.col("w") - SHINGLE)), F.least("pos", last))).alias("start")))
    both_sizes = F.col("size") + F.col("w") - 2 * (SHINGLE - 1)  # shingles of window and item
    enough = F.ceil(THRESHOLD * both_sizes / (1 + THRESHOLD) - 1e-9)
    windows = stored(starts.groupBy("doc", "w", "size", "start").agg(F.count(F.lit(1)).alias("c"))
                     .filter(F.col("c") >= enough).drop("c", "size"), "windows")
    words = (windows.join(near.select("doc", "h"), "doc")
             .select("doc", "w", "start", F.slice("h", F.col("start") + 1, F.col("w")).alias("x")))
    words = stored(words, "window_words")
    keys = ["doc", "w", "start"]

    # 3. multi-index
    prints = simhash(words.select(*keys, F.explode("x").alias("h")), keys)
    item_prints = simhash(item.select("item", "w", F.explode("h").alias("h")), ["item", "w"])
    index = stored(item_prints.select("item", "w", F.col("fp").alias("item_fp"), F.explode(blocks("fp")).alias("b"))
                   .select("item", "w", "item_fp", "b.*"), "index", 1)
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    candidates = stored(prints.select(*keys, "fp", F.explode(blocks("fp")).alias("b")).select(*keys, "fp", "b.*")
                        .join(small(index), ["w", "block", "bits"])
                        .select(*keys, "item", distance.alias("hamming")).filter(F.col("hamming") <= RADIUS)
                        .distinct(), "candidates")

    # 4. exact weighted similarity
    held = (words.select(*keys, F.size("x").alias("size"), F.explode(shingles("x")).alias("sh"))
            .groupBy(*keys, "size", "sh").agg(F.count(F.lit(1)).alias("n_window")))
    both = (candidates.join(held, keys).join(small(counted.drop("w")), ["item", "sh"])
            .groupBy(*keys, "size", "item", "hamming").agg(F.sum(F.least("n_window", "n_item")).alias("both")))
    similarity = F.col("both") / (both_sizes - F.col("both"))
    found = both.withColumn("similarity", similarity).filter(F.col("similarity") >= THRESHOLD - 1e-12)
    best = (found.groupBy("doc", "item").agg(
        F.max(F.struct("similarity", -F.col("hamming"), -F.col("start"), "size")).alias("b"),
        F.count(F.lit(1)).alias("n_windows"))
        .select("doc", "item", F.col("b.similarity").alias("similarity"), (-F.col("b.col2")).alias("hamming"),
                (-F.col("b.col3")).alias("window_start"), F.col("b.size").alias("window_words"), "n_windows"))
    return (few(best.join(near.select("doc", "doc_id"), "doc").join(item.select("item", "item_id"), "item"))
            .select("doc_id", "item_id", "similarity", "hamming", "window_start", "window_words", "n_windows"))


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold an item."""
    gone = stored(find_leaks(docs, items).select(F.col("doc_id").alias("_gone")).distinct(), "leaks")
    return docs.join(small(gone), F.col("doc_id").eqNullSafe(F.col("_gone")), "left_anti")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
