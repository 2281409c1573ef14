"""Benchmark items in documents that are shorter than the item."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from lexiq.llm import decontaminate

from test_operators import DOCS, prose, words_of


def brute_leaks(rows, items) -> dict:
    """(similarity, words of the window) of the best window, which is the whole text where that is shorter than the item."""
    out = {}
    for item_id, text in items:
        w = words_of(text.lower())
        item = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        for r in rows:
            d = words_of((r[1] or "").lower())
            size = min(len(w), len(d))
            for start in range(len(d) - size + 1):
                x = d[start:start + size]
                window = Counter(tuple(x[i:i + 5]) for i in range(len(x) - 4))
                both = sum((window & item).values())
                total = sum(window.values()) + sum(item.values()) - both
                if total and both / total >= 0.8 - 1e-12:
                    out[r[0], item_id] = max((both / total, size), out.get((r[0], item_id), (0, 0)))
    return out


def test_documents_shorter_than_the_item(spark):
    rng = random.Random(12)
    items = [(i, prose(rng, n)) for i, n in enumerate([5, 6, 9, 9, 14, 24, 40, 59, 59, 63])]
    items.append((20, "go " * 30))
    rows = [(1, None), (2, ""), (3, "go go"), (4, prose(rng, 30))]
    for i, text in items:
        w = text.split()
        for cut in range(15):  # less its last words, its first words, or some of both
            for k, part in enumerate([w[:len(w) - cut], w[cut:], w[cut // 2:len(w) - (cut - cut // 2)]]):
                rows.append((1000 * (i + 1) + 10 * cut + k, " ".join(part)))
        rows.append((1000 * (i + 1) + 500, " ".join(["other"] + w[2:])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame([(*r, None, None, None, None) for r in rows], DOCS)
    got = {(r.doc_id, r.item_id): (r.similarity, r.window_words) for r in decontaminate.find_leaks(df, bench).collect()}
    want = brute_leaks(rows, items)
    short = {k for k, v in want.items() if v[1] < len(dict(items)[k[1]].split())}
    assert got.keys() == want.keys() and len(short) > 100
    assert all(abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1] == want[k][1] for k in got)
    assert (1000 * 8 + 10, 7) in short  # 59 words less the last one
    left = {r.doc_id for r in decontaminate.without_leaks(df, bench).collect()}
    assert left == {r[0] for r in rows} - {k[0] for k in want}


def test_items_too_long_for_the_counters_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "FIELD_BITS", 4)
    docs = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(16)))], "item_id long, text string")
    with pytest.raises(ValueError, match="an item has 16 words"):
        decontaminate.find_leaks(docs, items)
