"""Substring dedup by seed and extend: repeats of ``LENGTH`` words or more across documents.

Seeds: winnowing over hashes of ``SEED_WORDS`` words. Of the seeds inside any window of ``LENGTH``
words the smallest is an anchor, so two documents that share a window share an anchor at the same
place in it. Anchors of one text only are dropped.

Extension: a match is extended from its anchor to both sides by whole windows, not by comparing two
texts word by word: all windows that hold a shared anchor are hashed, and windows with the same hash
in documents with different ids are the match. A window's first document is a minimum per hash, so a passage that a third of all
documents share costs one row per place, and no pair of documents is ever written. Consecutive
matched windows form a maximal repeat; its words are removed in every document but the first.

Texts with the same words are one class: its members with larger ids are repeats as a whole
(from ``LENGTH`` words on), only the first member is searched. Words and windows are compared by
64-bit hashes.

Null text has no words; shorter texts than ``LENGTH`` words are kept. A null id counts as larger
than any other, and rows with the same id are not copies of each other. An empty table gives no
rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .common import documents, few, small, stored

LENGTH, SEED_WORDS = 50, 10
_LAST = (1 << 63) - 1
_START_BITS = 31
#: Rows of at most four longs that are broadcast: about 6 MB.
BROADCAST_ROWS = 50_000


def _slide(values: np.ndarray, n: int, op: np.ufunc) -> np.ndarray:
    """``op`` over ``values[i:i + n]`` for every i (fewer at the end), by doubling."""
    out, width = values, 1
    while width < n:
        step = min(width, n - width)
        grown = out.copy()
        if step < len(out):
            op(out[:-step], out[step:], out=grown[:-step])
        out, width = grown, width + step
    return out


def anchors(w: W.Words, hashes: np.ndarray, length: int = LENGTH, k: int = SEED_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(word number in the slice, seed hash) of every winnowed seed of a slice."""
    seeds, whole = W.grams(hashes, w.first, k)
    left = np.repeat(w.first[1:], w.counts) - np.arange(len(hashes))
    per_window = length - k + 1
    least = np.where(left >= length, _slide(seeds, per_window, np.minimum), np.uint64(0))
    # a seed is an anchor if it is the minimum of some window that holds it
    most = _slide(least[::-1], per_window, np.maximum)[::-1]
    at = np.flatnonzero(whole & (most == seeds))
    return at, seeds[at]


def text_hashes(w: W.Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the word sequence of every document."""
    place = (np.arange(len(hashes)) - np.repeat(w.first[:-1], w.counts)).astype(np.uint64)
    out = []
    for salt in (0x9FB21C651E98DF25, 0xD1B54A32D192ED03):
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(W.mix(hashes + W.mix(place + np.uint64(salt))), out=sums[1:])
        out.append(W.mix(sums[w.first[1:]] - sums[w.first[:-1]] + w.counts.astype(np.uint64)))
    return out[0], out[1]


def _kept_sha(text: bytes, removed: np.ndarray | None = None) -> str:
    found = text.split()
    if removed is not None:
        found = [x for x, gone in zip(found, removed) if not gone]
    return hashlib.sha256(b" ".join(found)).hexdigest()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w in W.slices(batch.column("text")):
            hashes = w.hashes()
            at, seeds = anchors(w, hashes)
            h1, h2 = text_hashes(w, hashes)
            bounds = pa.array(np.searchsorted(at, w.first).astype(np.int32))
            place = (at - w.first[np.searchsorted(w.first, at, "right") - 1]).astype(np.int32)
            data = w.data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(w.row, w.n_docs), pa.array(w.counts),
                 pa.array(W.signed(h1)), pa.array(W.signed(h2)),
                 pa.array([_kept_sha(data[a:b]) for a, b in zip(w.offsets[:-1], w.offsets[1:])], pa.string()),
                 pa.ListArray.from_arrays(bounds, pa.array(W.signed(seeds))),
                 pa.ListArray.from_arrays(bounds, pa.array(place))],
                names=["doc_id", "n_words", "h1", "h2", "sha", "seeds", "places"])


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the rows whose text has the hash ``h1`` (ids may repeat)."""
    for batch in batches:
        keep = [W.signed(text_hashes(w, w.hashes())[0]) for w in W.slices(batch.column("text"))]
        same = np.concatenate(keep) == batch.column("h1").to_numpy() if keep else np.zeros(0, bool)
        yield batch.filter(pa.array(same)).select(["rank", "tag", "text", "places"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, rank, place) of every window that holds a shared anchor; place packs tag and start."""
    per_window = LENGTH - SEED_WORDS + 1
    for batch in batches:
        rank, tag = (batch.column(c).to_numpy() for c in ("rank", "tag"))
        places = batch.column("places")
        flat, bounds = places.values.to_numpy(), places.offsets.to_numpy()
        for w in W.slices(batch.column("text")):
            lo, hi = bounds[w.row], bounds[w.row + w.n_docs]
            doc = np.repeat(np.arange(w.n_docs), np.diff(bounds[w.row:w.row + w.n_docs + 1]))
            at = flat[lo:hi].astype(np.int64)
            begin = w.first[doc] + np.maximum(at - per_window + 1, 0)
            end = w.first[doc] + np.minimum(at, w.counts[doc] - LENGTH) + 1
            level = np.zeros(len(w.starts) + 1, np.int64)
            np.add.at(level, begin, 1)
            np.add.at(level, end, -1)
            start = np.flatnonzero(np.cumsum(level)[:-1] > 0)
            hashes, _ = W.grams(w.hashes(), w.first, LENGTH)
            owner = np.searchsorted(w.first, start, "right") - 1
            place = (tag[w.row + owner] << _START_BITS) | (start - w.first[owner])
            yield pa.RecordBatch.from_arrays(
                [pa.array(W.signed(hashes[start])), pa.array(rank[w.row + owner]), pa.array(place)],
                names=["hash", "rank", "place"])


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans, number of removed words and the kept text's digest from the starts of matched windows."""
    for batch in batches:
        out: dict[str, list] = {c: [] for c in ("n_removed", "sha", "spans")}
        starts = batch.column("starts")
        flat, bounds = starts.values.to_numpy(), starts.offsets.to_numpy()
        for w in W.slices(batch.column("text")):
            for i in range(w.n_docs):
                level = np.zeros(int(w.counts[i]) + 1, np.int64)
                mine = np.unique(flat[bounds[w.row + i]:bounds[w.row + i + 1]])
                level[mine] += 1
                np.subtract.at(level, np.minimum(mine + LENGTH, len(level) - 1), 1)
                gone = np.cumsum(level)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                out["n_removed"].append(int(gone.sum()))
                out["sha"].append(_kept_sha(w.data[w.offsets[i]:w.offsets[i + 1]].tobytes(), gone))
                out["spans"].append([{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])])
        yield pa.RecordBatch.from_arrays(
            [batch.column("rank"), batch.column("tag"), pa.array(out["n_removed"], pa.int64()),
             pa.array(out["sha"], pa.string()),
             pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
            names=["rank", "tag", "n_removed", "sha", "spans"])


def find_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, spans) of every row of ``docs`` (doc_id, text);
    ``spans`` are the maximal repeats as word ranges [start, end)."""
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("rank")
    tag = F.shiftrightunsigned("h1", 64 - _START_BITS - 1).alias("tag")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = stored(texts.mapInArrow(_sketch, "doc_id long, n_words long, h1 long, h2 long, sha string, "
                                              "seeds array<long>, places array<int>"), "sketch", None)
    narrow = sketch.select("doc_id", rank, tag, "n_words", "h1", "h2", "sha")
    # tables that are joined by the key they were grouped by are stored first: a hot key (texts without words, a
    # passage that many documents share) is then a plain join, which Spark splits
    classes = stored(narrow.groupBy("h1", "h2", "n_words").agg(F.min("rank").alias("first")), "firsts")
    marked = stored(narrow.join(small(classes, BROADCAST_ROWS), ["h1", "h2", "n_words"]).withColumn(
        "copy", (F.col("rank") > F.col("first")) & (F.col("n_words") >= LENGTH)).drop("first", "h2"), "classes")

    # seeds that occur in texts of two classes or more
    seeds = sketch.select(rank, tag, "h1", F.explode(F.arrays_zip("seeds", "places")).alias("a")).select(
        "rank", "tag", "h1", F.col("a.seeds").alias("seed"), F.col("a.places").alias("at"))
    shared = (seeds.groupBy("seed").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"))
              .filter("lo <> hi").select("seed"))
    shared = small(stored(shared, "shared"), BROADCAST_ROWS)
    own = marked.filter(~F.col("copy")).select("rank", "tag", "h1").distinct()
    places = (seeds.drop("h1").join(shared, "seed").groupBy("rank", "tag").agg(F.collect_set("at").alias("places"))
              .join(own, ["rank", "tag"]))
    places = stored(places, "anchors")
    found = (texts.select(rank, "text").join(small(places.select("rank").distinct()), "rank", "left_semi")
             .join(places, "rank").select("rank", "tag", "h1", "text", "places"))
    found = stored(found.mapInArrow(_matched, "rank long, tag long, text string, places array<int>")
                   .dropDuplicates(["rank", "tag"]), "anchored", 8)

    # windows around shared anchors: the first document of each, and the others
    windows = found.mapInArrow(_windows, "hash long, rank long, place long")
    firsts = (windows.groupBy("hash").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
              .filter("first < last").select("hash", "first"))
    firsts = small(stored(firsts, "first_windows"), BROADCAST_ROWS)
    later = (windows.join(firsts, "hash").filter(F.col("rank") > F.col("first"))
             .groupBy("rank", F.shiftright("place", _START_BITS).alias("tag"))
             .agg(F.collect_list(F.col("place").bitwiseAND(F.lit((1 << _START_BITS) - 1)).cast("int")).alias("starts")))
    cut = (found.drop("places").join(later, ["rank", "tag"])
           .mapInArrow(_removed, "rank long, tag long, n_removed long, sha string, "
                                 "spans array<struct<start:int,end:int>>"))
    cut = cut.select("rank", "tag", "n_removed", F.col("sha").alias("cut_sha"), "spans")

    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    nothing = F.array().cast("array<struct<start:int,end:int>>")
    return few(marked.join(cut, ["rank", "tag"], "left")).select(
        "doc_id", "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), F.lit(hashlib.sha256(b"").hexdigest())).otherwise(
            F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
        F.when(F.col("copy"), whole).otherwise(F.coalesce("spans", nothing)).alias("spans"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_repeats(documents(spark, sf_dir))
