"""SimHash near duplicates by anchors, against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from lexiq.llm import simhash
from lexiq.llm.components import components

ROWS = "doc_id long, text string, fp string, component_id int"


def brute_fingerprint(text: str | None) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def brute_classes(fps: list[int]) -> list[int]:
    """A class number per fingerprint, by comparing all."""
    u = np.unique(np.array(fps, np.uint64))
    root = np.arange(len(u))
    changed = True
    while changed:
        before = root.copy()
        for i in range(len(u)):
            near = np.bitwise_count(u ^ u[i]) <= 3
            root[near] = root[near].min()
        changed = (root != before).any()
    return root[np.searchsorted(u, np.array(fps, np.uint64))].tolist()


def texts() -> list[tuple]:
    rng = random.Random(4)
    names = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrst"]
    base = [" ".join(rng.choice(names) for _ in range(rng.randint(40, 400))) for _ in range(25)]
    out: list[str | None] = list(base)
    for _ in range(60):  # copies with some words changed
        words = rng.choice(base[:5]).split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(names)
        out.append(rng.choice([" ", "\n", "\t "]).join(words))
    out += [None, "", " \x0b\n", "one", "ONE", "one two", "One\ttwo", "one two three", "Ünï Çode ÀB", "x" * 3000,
            "very long " * 300_000, base[0].upper(), base[0]]
    return [(i, t, "f", 1) for i, t in enumerate(out)] + [(None, base[1], None, None), (None, "no other text like this", "g", 2),
                                                          (3, out[3], None, None), (2, base[4], None, None)]


def test_documents_match_all_pairs(spark):
    rows = texts()
    got = simhash.near_duplicates(spark.createDataFrame(rows, ROWS).repartition(4)).collect()
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    classes, first = brute_classes(fps), {}
    for (doc_id, *_), c in zip(rows, classes):
        ids = [x for x in (first.get(c), doc_id) if x is not None]
        first[c] = min(ids) if ids else None
    want = sorted((doc_id is None, doc_id or 0, f, first[c] is None, first[c] or 0)
                  for (doc_id, *_), f, c in zip(rows, fps, classes))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fp & (1 << 64) - 1, r.component_id is None, r.component_id or 0)
                  for r in got) == want


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], ROWS)).collect() == []


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_pieces_of_a_text_change_nothing(monkeypatch, piece):
    monkeypatch.setattr(simhash, "PIECE", piece)
    for _, text, *_ in texts()[:95]:
        if len(text or "") < 5000:
            assert simhash.fingerprint((text or "").encode()) == brute_fingerprint(text)


@pytest.mark.parametrize("b", [5, 3])
@pytest.mark.parametrize("crowd", [False, True])
def test_links_of_anchors_connect_what_all_pairs_connect(spark, monkeypatch, b, crowd):
    """Chains of fingerprints some bits apart; a crowd around few points is cut into cells."""
    monkeypatch.setattr(simhash, "LENGTHS", ((b, 1 << 62),))
    if crowd:
        monkeypatch.setattr(simhash, "LIVE", 16)
        monkeypatch.setattr(simhash, "CAME", 64)
    rng = np.random.default_rng(b)
    points = [int(x) for x in rng.integers(0, 1 << 63, 3 if crowd else 200, dtype=np.uint64)]
    for _ in range(1200):
        x = points[rng.integers(3 if crowd else len(points))]
        for bit in rng.choice(64, rng.integers(1, 7 if crowd else 5), replace=False):
            x ^= 1 << int(bit)
        points.append(x)
    u = np.unique(np.array(points, np.uint64))
    nodes = spark.createDataFrame([(int(x),) for x in u.view(np.int64)], "fp long").repartition(3)
    if crowd:
        assert simhash.crowded(nodes, b, len(u))
    found = simhash.links(nodes)
    for r in found.collect():
        assert 0 < ((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 3
    root = {r.node: r.root for r in components(found).collect()}
    got = [root.get(int(x), int(x)) for x in u.view(np.int64)]
    want = brute_classes(u.tolist())
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_every_pair_in_reach_meets_at_an_anchor():
    """Pairs at each distance: one of the two comes to the other's home if and only if it may."""
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for distance in (1, 2, 3):
        y = x.copy()
        for i in range(len(y)):
            for bit in rng.choice(64, distance, replace=False):
                y[i] ^= np.uint64(1 << int(bit))
        for b in (5, 3):
            met = np.zeros(len(x), bool)
            for left, right in ((x, y), (y, x)):
                home = simhash.homes(right, b)[0]
                for rows, to in simhash.copies(left, b):
                    met[rows[to == home[rows]]] = True
            assert met.all()
