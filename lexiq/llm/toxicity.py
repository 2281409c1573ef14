"""Toxicity by compression distance with two zstandard dictionaries.

Fit, on the driver, from a bounded sample: of the labelled rows at most ``SAMPLE`` per class, whose
texts differ (near copies are dropped) and have at most ``SAMPLE_CHARS`` characters, the smallest by a hash of their id. On
two thirds of them zstandard trains two dictionaries: one over the windows of ordinary texts, and one over the
windows of toxic texts without the words that are no sign of them (in fewer than ``MIN_SHARE`` of the
toxic texts, or not ``MIN_ODDS`` times as frequent there as in ordinary ones; trained on toxic windows as
they are it holds mostly what all texts share: AUC 0.70 instead of 0.99 on the check tables). The toxic
model is the first dictionary followed by the second, the ordinary model the first alone, so that
what both classes share saves nothing. The last third calibrates: the saving of a window is the bytes that it takes with the
ordinary dictionary less those with the toxic one; each saving has a log-likelihood ratio between
windows of toxic and of ordinary texts, and a document's score is a logistic function, weighted
to the true class sizes, of the sum over its windows and of their number. Dictionaries are of
fixed size, so the model doesn't grow with the corpus.

Scoring: every whole text is lower-cased (ASCII), its marks become spaces, and it is cut at spaces
into windows of ``WINDOW`` bytes or a little more. Matches shorter than ``MIN_MATCH`` bytes are off,
so a saving comes from whole words.

Null and empty texts have no window and get the score of no evidence. If a class has no labelled
row, nothing can be learned and all scores are 0. Rows that repeat are scored each; repeated labels
of an id count as toxic if one is. Labels, ids, languages and sources are not used by the score. An
empty table gives no rows. Columns that aren't asked for by ``keep`` are ignored; one named ``score`` can't be kept.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .common import documents, small, stored
from .ngram_join import min_hashes, token_sets

SAMPLE, SAMPLE_CHARS = 4000, 20_000
WINDOW, MIN_MATCH = 160, 6
BASE_BYTES, TOXIC_BYTES = 16384, 1024
MIN_TEXTS, MIN_SHARE, MIN_ODDS = 4, 0.015, 20
SAVINGS = (-4, 12)
THRESHOLD = 0.3
_FOLD = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\"()\n\t\r\x0b\x0c",
                                                    b"abcdefghijklmnopqrstuvwxyz              "))


class Model(NamedTuple):
    ordinary: bytes
    toxic: bytes
    ratios: tuple[float, ...]
    weights: tuple[float, ...]


def windows(text: bytes) -> list[bytes]:
    """The whole text in windows that begin at a space and end before one."""
    folded = b" " + text.translate(_FOLD).rstrip()
    out, at = [], 0
    while at < len(folded) - 1:
        end = folded.find(b" ", at + WINDOW)
        end = len(folded) if end < 0 else end
        out.append(folded[at:end] + b" ")
        at = end
    return out


def compressor(dictionary: bytes) -> zstd.ZstdCompressor:
    data = zstd.ZstdCompressionDict(dictionary, dict_type=zstd.DICT_TYPE_FULLDICT)
    parameters = zstd.ZstdCompressionParameters(
        window_log=17, chain_log=15, hash_log=15, search_log=4, min_match=MIN_MATCH, target_length=8,
        strategy=zstd.STRATEGY_GREEDY, write_content_size=0, write_dict_id=0, write_checksum=0,
        format=zstd.FORMAT_ZSTD1_MAGICLESS)
    data.precompute_compress(compression_params=parameters)
    return zstd.ZstdCompressor(dict_data=data, compression_params=parameters)


@lru_cache(maxsize=2)
def compressors(model: Model) -> tuple[zstd.ZstdCompressor, zstd.ZstdCompressor]:
    return compressor(model.ordinary), compressor(model.toxic)


def savings(pair: tuple[zstd.ZstdCompressor, zstd.ZstdCompressor], text: bytes) -> np.ndarray:
    """How often each saving occurs among the windows of a text; the ends of SAVINGS take what is beyond."""
    ordinary, toxic = pair[0].compress, pair[1].compress
    saved = np.fromiter((len(ordinary(w)) - len(toxic(w)) for w in windows(text)), np.int64)
    return np.bincount(np.clip(saved, *SAVINGS) - SAVINGS[0], minlength=SAVINGS[1] - SAVINGS[0] + 1)


def evidence(counts: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Inputs of the logistic function for rows of saving counts."""
    return np.stack([np.ones(len(counts)), counts @ ratios, np.log1p(counts.sum(1))], 1)


def _spread(texts: list[bytes]) -> Counter:
    """In how many texts each word occurs."""
    out: Counter = Counter()
    for t in texts:
        out.update(set(t.translate(_FOLD).split()))
    return out


def _apart(texts: list[bytes]) -> list[bytes]:
    """The texts without near copies of earlier ones: those that share one of three min-hashes of
    their shingles. Else the words of one much copied text would pass for those of a class."""
    seen: set[tuple[int, int]] = set()
    out = []
    for w in W.slices(pa.array([t.decode("utf-8", "replace") for t in texts], pa.large_string())):
        for i, mins in enumerate(min_hashes(*token_sets(w))[:, :3]):
            keys = set(enumerate(mins.tolist()))
            if not keys & seen:
                out.append(texts[w.row + i])
            seen |= keys
    return out


def fit(ordinary: list[bytes], toxic: list[bytes], n_ordinary: int, n_toxic: int) -> Model | None:
    """The model from sampled texts of both classes (in sample order) and the numbers of labelled rows."""
    ordinary, toxic = _apart(ordinary), _apart(toxic)
    if len(ordinary) < 3 or len(toxic) < 3:
        return None
    build = [[t for i, t in enumerate(x) if i % 3] for x in (ordinary, toxic)]
    probe = [x[::3] for x in (ordinary, toxic)]
    usual, hard = _spread(build[0]), _spread(build[1])
    odds, least = len(build[0]) / len(build[1]), max(MIN_TEXTS, MIN_SHARE * len(build[1]))
    signs = {w for w, n in hard.items() if n >= least and n * odds >= MIN_ODDS * usual[w]}
    pools = [[w for t in build[0] for w in windows(t)], [_kept(w, signs) for t in build[1] for w in windows(t)]]
    try:
        base = zstd.train_dictionary(BASE_BYTES, pools[0]).as_bytes()
        tail = zstd.train_dictionary(TOXIC_BYTES, [w for w in pools[1] if len(w) > MIN_MATCH + 2]).as_bytes()
    except zstd.ZstdError:  # too few samples for a dictionary of this size
        return None
    return _calibrated((base + b" ", base + b" " + tail + b" "), probe, [n_ordinary / len(probe[0]), n_toxic / len(probe[1])])


def _kept(window: bytes, signs: set[bytes]) -> bytes:
    return b" " + b" ".join(w for w in window.split() if w in signs) + b" "


def _calibrated(dictionaries: tuple[bytes, bytes], probe: list[list[bytes]], each: list[float]) -> Model:
    """The model with the ratios and weights that ``probe``, texts of both classes, gives; ``each`` is how
    many labelled rows one of them stands for."""
    draft = Model(*dictionaries, (), ())
    pair = compressors(draft)
    counts = [np.array([savings(pair, t) for t in x]) for x in probe]
    share = [(c.sum(0) + 0.5) / (c.sum() + 0.5 * c.shape[1]) for c in counts]
    ratios = np.log(share[1] / share[0])
    x = np.concatenate([evidence(c, ratios) for c in counts])
    y = np.repeat([0.0, 1.0], [len(c) for c in counts])
    size = np.repeat(each, [len(c) for c in counts])
    weights = _logistic(x, y, size / size.sum() * len(y))
    return draft._replace(ratios=tuple(ratios.tolist()), weights=tuple(weights.tolist()))


def _logistic(x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (size * (y - p)) - 1e-2 * w
        step = np.linalg.solve((x * (size * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w)), slope)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on ``labels`` (doc_id, toxic) and the texts of ``docs`` (doc_id, text)."""
    marks = labels.filter("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    found = stored(docs.select("doc_id", F.xxhash64("text").alias("key"), F.length("text").alias("n"))
                   .filter("n > 0").join(marks, "doc_id"), "labelled")
    totals = {r["toxic"]: r["n"] for r in found.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    distinct = found.filter(F.col("n") <= SAMPLE_CHARS).groupBy("key", "toxic").agg(F.min("doc_id").alias("doc_id"))
    order = F.xxhash64("doc_id", F.lit(8))
    picked = None
    for label in (0, 1):
        part = distinct.filter(F.col("toxic") == label).orderBy(order, "doc_id").limit(SAMPLE)
        picked = part if picked is None else picked.union(part)
    picked = stored(picked, "sample")
    rows = (docs.withColumn("key", F.xxhash64("text")).join(small(picked), ["doc_id", "key"])
            .select("doc_id", "toxic", "text").dropDuplicates(["doc_id", "toxic"]).orderBy(order, "doc_id").collect())
    texts = {label: [r["text"].encode() for r in rows if r["toxic"] == label] for label in (0, 1)}
    return fit(texts[0], texts[1], totals.get(0, 0), totals.get(1, 0))


def score(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``score``, from 0 to 1."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            if model is not None and batch.num_rows:
                pair, ratios = compressors(model), np.array(model.ratios)
                data, offsets = W.text_buffers(batch.column("text"))
                counts = np.array([savings(pair, data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])])
                scores = 1 / (1 + np.exp(-np.clip(evidence(counts, ratios) @ np.array(model.weights), -30, 30)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(scores)],
                                             names=[*keep, "score"])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, f"{schema}, score double")


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learned from: crc32 of the id's digits leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out(F.col("doc_id")))
    scored = score(docs, learn(docs, labels), ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
