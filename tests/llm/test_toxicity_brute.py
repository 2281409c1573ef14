"""Savings and scores of the toxicity model, recomputed text by text."""

from __future__ import annotations

import math
import random

import pytest
import zstandard as zstd
from pyspark.sql import functions as F

from lexiq.llm import toxicity

from test_operators import prose

MARKS = ".,;:!?\"()\n\t\r\x0b\x0c"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    bad = ["vexgrimble", "drokhatter", "smulfangle", "quarnsedge", "blithorken"]
    out = []
    for i in range(700):
        words = prose(rng, rng.randint(40, 220)).split()
        for _ in range(5 if i % 5 == 0 else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        out.append((i, " ".join(words), float(i), "x"))
    out += [(700, None, 0.0, "x"), (701, "", 0.0, "x"), (702, "Ünï (CODE)!\n" * 40, 0.0, "x"), (None, "vexgrimble " * 60, 0.0, "x")]
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, score double, extra string").repartition(4)


@pytest.fixture(scope="module")
def model(spark, table, rows):
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, *_ in rows if i is not None and i < 700], "doc_id long, toxic int")
    return toxicity.learn(table, labels.filter(~toxicity.held_out(F.col("doc_id"))))


def brute(model, text: str | None) -> float:
    raw = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else " " if c in MARKS else c for c in text or "").rstrip(" ")
    counts, rest = {}, raw.encode()
    data = b" " + rest if rest else b""
    while data:
        end = data.find(b" ", toxicity.WINDOW)
        window, data = (data, b"") if end < 0 else (data[:end], data[end:])
        if window.strip(b" ") or data:
            sizes = [len(toxicity.compressor(d).compress(window + b" ")) for d in (model.ordinary, model.toxic)]
            low, high = toxicity.SAVINGS
            saved = min(high, max(low, sizes[0] - sizes[1]))
            counts[saved] = counts.get(saved, 0) + 1
    ratio = sum(n * model.ratios[s - toxicity.SAVINGS[0]] for s, n in counts.items())
    w = model.weights
    return 1 / (1 + math.exp(-(w[0] + w[1] * ratio + w[2] * math.log1p(sum(counts.values())))))


def test_scores_are_those_of_a_direct_computation(table, rows, model):
    got = toxicity.score(table, model, ["doc_id"]).collect()
    want = sorted((r[0] is None, r[0] or 0, round(brute(model, r[1]), 9)) for r in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, round(r.score, 9)) for r in got) == want


def test_both_dictionaries_are_trained_and_toxic_text_saves(model):
    assert model.ordinary != model.toxic and model.toxic.startswith(model.ordinary)
    for d in (model.ordinary, model.toxic[len(model.ordinary):]):
        assert d.lstrip(b" ")[:4] == b"\x37\xa4\x30\xec"  # each part was made by zstandard's training
    pair = toxicity.compressors(model)
    assert toxicity.savings(pair, b"ordinary talk of vexgrimble and drokhatter")[-toxicity.SAVINGS[0] + 1:].sum() == 1
    assert isinstance(pair[0], zstd.ZstdCompressor)


def test_held_out_rows(table, rows, model):
    got = toxicity.score(table, model, ["doc_id"]).filter(toxicity.held_out(F.col("doc_id")) & (F.col("doc_id") < 700)).collect()
    hits = [(r.score >= toxicity.THRESHOLD, r.doc_id % 5 == 0) for r in got]
    assert sum(p == y for p, y in hits) / len(hits) > 0.97 and any(y for _, y in hits)


def test_extra_columns_are_ignored(table, model):
    assert toxicity.score(table, model, ["doc_id"]).columns == ["doc_id", "score"]
    assert toxicity.score(table, model, ["doc_id", "extra"]).columns == ["doc_id", "extra", "score"]
