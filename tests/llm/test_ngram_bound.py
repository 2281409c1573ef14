"""The bound over a range of set sizes, and links that depend on it."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from lexiq.llm import ngram_join

from test_operators import DOCS, brute_components


def needed(n: int, size: int) -> int:
    return -(-80 * (n + size) // 180) - max(-(-80 * n // 100), -(-80 * size // 100)) + 1


def test_bound_of_a_range_is_its_minimum(spark):
    rng = random.Random(7)
    rows = [(305, 378, 380)]
    for _ in range(20000):
        n = rng.randint(1, 5000)
        least, most = -(-80 * n // 100), 100 * n // 80
        low = rng.randint(least, most)
        rows.append((n, low, min(most, low + rng.choice([0, 1, 2, 3, 4, 8, 30, 400]))))
    df = spark.createDataFrame(rows, "n long, low long, high long")
    got = df.select("*", ngram_join.least_needed(F.col("n"), F.col("low"), F.col("high")).alias("x")).collect()
    assert all(r.x == min(needed(r.n, s) for s in range(r.low, r.high + 1)) for r in got)


def test_links_of_a_size_inside_a_class(spark, monkeypatch):
    """A links only with B, of 379 tokens, which stands in its class between sizes that need more shared
    tokens. Without step 1 the class must be opened for it."""
    monkeypatch.setattr(ngram_join, "AGREEING", ngram_join.MINHASHES + 1)
    words = lambda kind, n: [f"{kind}{i}" for i in range(n)]
    passage = words("p", 100)  # also in other texts, so its tokens come last in the order
    body, own = words("b", 208) + passage, words("o", 75)
    texts = [["a"] + body, own + body, ["front"] + own + body, (own + body)[:-1], words("x", 45) + passage,
             words("y", 55) + passage]
    rows = [(i, " ".join(t), None, None, None, None) for i, t in enumerate(texts)]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, DOCS)).select("doc_id", "n_shingles", "component_id")
    want = brute_components(rows)
    assert [w[1:] for w in want[:4]] == [(305, 0), (379, 0), (380, 0), (378, 0)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
