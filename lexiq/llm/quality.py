"""Quality rules: base rules and a hashed n-gram log-likelihood ratio.

Method: words and word pairs of a text are hashed into ``BUCKETS`` buckets. Two multinomials
are counted over them, one over all documents (raw corpus) and one over the trusted documents
(target). A document's score is the mean over its features of
``log p_target(bucket) - log p_raw(bucket)`` (length-normalised, additive smoothing). A trusted
document is scored against the target *without* its own counts, so trusted and other clean
documents are measured alike. Every document is kept if its score is at least a threshold, and
the threshold is one number from the bulk of the trusted scores: ``median - MARGIN * (median - low)``
where low is their ``LOW_SHARE`` quantile and the distance counts as ``LEAST_SPREAD`` at least. Equal scores
(copies) count once. Less than ``LOW_SHARE`` of mislabelled trusted documents can't move low among
themselves, so they don't switch the verdict off. Scores are counted in steps of ``1 / STEPS``
and no draw is made, so reruns agree.

What goes through the driver is the pair of multinomials, at most ``BUCKETS`` rows, and the counts
of the trusted scores' steps, some thousands, whatever the size of the corpus. The counts cover all
documents and all trusted documents.

Null text reads as empty: no words, base rules fail. An empty table gives an empty result; with
no trusted document there is no target and only the base rules decide. Rows are judged one by
one, so repeated rows get the same verdict. Input columns named like an output column are
replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .common import documents, small, stored, without

BUCKETS = 1 << 16
SMOOTHING = 1.0
LOW_SHARE, MARGIN, LEAST_SPREAD, STEPS = 0.1, 5.0, 0.01, 10_000
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = b"#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))


def features(w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document of the slice) of every word and every word pair."""
    h = w.hashes(lower=True)
    pair, whole = W.grams(h, w.first, 2)
    doc = w.doc_of_word()
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    bucket = np.concatenate([h >> shift, pair[whole] >> shift]).astype(np.int64)
    return bucket, np.concatenate([doc, doc[whole]])


def base_columns(w: W.Words) -> dict[str, np.ndarray]:
    """The counted columns of every document of a slice."""
    n, data = w.n_docs, w.data
    out = {"n_words": w.counts}
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    doc = w.doc_of_word()
    out["word_chars"] = np.bincount(doc, chars[w.ends] - chars[w.starts], n).astype(np.int64)
    out["n_symbols"] = W.per_doc(_SYMBOL[data], w.offsets)
    # lines: from a document's start or a newline to the next newline or the document's end
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([w.offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([w.offsets[1:], breaks]), kind="stable")
    worded = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends = starts[worded], ends[worded]
    owner = np.searchsorted(w.offsets, starts, "right") - 1
    _, again = W.repeated(W.span_hashes(data, starts, ends), owner)
    out["n_dup_lines"] = np.bincount(owner[again], minlength=n)
    triple, whole = W.grams(w.hashes(), w.first, 3)
    at = np.flatnonzero(whole)
    many, _ = W.repeated(triple[at], doc[at])
    covered = np.zeros(len(doc) + 2, bool)
    for i in range(3):
        covered[at[many] + i] = True
    out["n_repeat_words"] = W.per_doc(covered[:len(doc)], w.first)
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, raw, target) of one task's documents, the buckets that occur."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        trusted = batch.column("trusted").to_numpy(zero_copy_only=False)
        for w in W.slices(batch.column("text")):
            bucket, doc = features(w)
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[trusted[w.row + doc]], minlength=BUCKETS)
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])],
                                     names=["bucket", "raw", "target"])


class Ratio:
    """Log-likelihood ratio of the two multinomials; a fixed table of BUCKETS numbers."""

    def __init__(self, raw: np.ndarray, target: np.ndarray):
        self.target, self.total = target, int(target.sum())
        self.raw_log = np.log((raw + SMOOTHING) / (raw.sum() + SMOOTHING * BUCKETS))

    def scores(self, w: W.Words, trusted: np.ndarray) -> np.ndarray:
        bucket, doc = features(w)
        n = w.n_docs
        size = np.bincount(doc, minlength=n)
        own = trusted[doc]
        seen, outside = self.target[bucket].astype(float), np.full(n, float(self.total))
        if own.any():
            key, where, times = np.unique(doc[own] * BUCKETS + bucket[own], return_inverse=True, return_counts=True)
            seen[own] -= times[where]
            outside[trusted] -= size[trusted]
        ratio = np.log(seen + SMOOTHING) - self.raw_log[bucket]
        total = np.bincount(doc, ratio, n) - size * np.log(outside + SMOOTHING * BUCKETS)
        return total / np.maximum(size, 1)


def mark_trusted(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """``docs`` with a boolean column ``trusted``; ids are longs, so the count bounds the bytes."""
    ids = stored(trusted_ids.select(F.col("doc_id").alias("_trusted")).filter("_trusted IS NOT NULL").distinct(),
                 "trusted")
    return (docs.join(small(ids), docs["doc_id"] == F.col("_trusted"), "left")
            .withColumn("trusted", F.col("_trusted").isNotNull()).drop("_trusted"))


def multinomials(marked: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = (marked.select("text", "trusted").mapInArrow(_counted, "bucket long, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas())
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    raw[rows.bucket], target[rows.bucket] = rows.raw, rows.target
    return raw, target


def score(docs: DataFrame, trusted_ids: DataFrame) -> tuple[DataFrame, float]:
    """``docs`` (doc_id, text, ...) with the base columns, ``base_failed``, ``llr`` and ``trusted``, and
    the threshold on ``llr``."""
    added = [*BASE, "base_failed", "llr", "trusted"]
    marked = mark_trusted(without(docs, added + ["kept", "_trusted"]), trusted_ids)
    ratio = Ratio(*multinomials(marked))
    kept = [f for f in marked.schema.fields if f.name != "trusted"]
    schema = T.StructType(kept + [T.StructField(c, T.LongType()) for c in BASE]
                          + [T.StructField("base_failed", T.BooleanType()), T.StructField("llr", T.DoubleType()),
                             T.StructField("trusted", T.BooleanType())])
    names = [f.name for f in kept]

    def judged(batches: Iterator[pa.RecordBatch], only_trusted: bool = False) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if only_trusted:
                batch = batch.filter(batch.column("trusted"))
            trusted = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
            parts = [base_columns(w) | {"llr": ratio.scores(w, trusted[w.row:w.row + w.n_docs])}
                     for w in W.slices(batch.column("text"))]
            if not parts:
                continue
            c = {k: np.concatenate([p[k] for p in parts]) for k in [*BASE, "llr"]}
            c["base_failed"] = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"]
                                                             > MAX_REPEAT_PERCENT * c["n_words"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(c[k]) for k in [*BASE, "base_failed", "llr"]]
                + [batch.column("trusted")], names=[*names, *BASE, "base_failed", "llr", "trusted"])

    threshold = -math.inf
    if ratio.total:
        steps = (marked.filter("trusted").select("text", "trusted")
                 .mapInArrow(_calibration(ratio), "llr double").distinct()
                 .groupBy(F.floor(F.col("llr") * STEPS).alias("step")).agg(F.count(F.lit(1)).alias("n")).toPandas())
        threshold = threshold_of(steps["step"].to_numpy(np.int64), steps["n"].to_numpy(np.int64))
    return marked.mapInArrow(judged, schema), threshold


def threshold_of(steps: np.ndarray, n: np.ndarray) -> float:
    """The threshold from the numbers ``n`` of trusted scores in each of ``steps``."""
    if not len(steps):
        return -math.inf
    order = np.argsort(steps)
    upto = np.cumsum(n[order])
    low, mid = (steps[order][np.searchsorted(upto, share * upto[-1])] / STEPS for share in (LOW_SHARE, 0.5))
    return float(mid - MARGIN * max(mid - low, LEAST_SPREAD))


def _calibration(ratio: Ratio):
    """Scores of the trusted documents that pass the base rules."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in W.slices(batch.column("text")):
                base = base_columns(w)
                fine = (base["n_words"] >= MIN_WORDS) & (100 * base["n_repeat_words"]
                                                         <= MAX_REPEAT_PERCENT * base["n_words"])
                llr = ratio.scores(w, np.ones(w.n_docs, bool))
                yield pa.RecordBatch.from_arrays([pa.array(llr[fine])], names=["llr"])
    return run


def quality_rules(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """Every document with its base columns, score and verdict ``kept``."""
    scored, threshold = score(docs, trusted_ids)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(threshold)))


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").select("doc_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(documents(spark, sf_dir).select("doc_id", "text"), trusted_ids(spark, sf_dir))
    return out.select("doc_id", *BASE, "base_failed", "kept", F.col("llr").alias("score"))
