"""SimHash near duplicates by anchor points of a covering code.

A document's fingerprint has 64 bits. Its text is lower-cased (A-Z) and cut into words; its features
are the 3-word shingles, repeats included, as space-joined UTF-8 (a shorter text is one feature: its
whole word sequence), hashed by XXH64 with seed 42. A bit is 1 if more than half of the hashes have it.
Fingerprints that differ in at most ``RADIUS`` bits link; the result is each document's component.

The fingerprint's bits are cut into blocks of ``b`` bits, b odd, and the rest. The anchors are the
words whose blocks are all zeros or all ones: a product of repetition codes with 2^(64 // b) words
that covers the space, each block within r = (b - 1) / 2 bits of exactly one of its two codewords.

* Every fingerprint lives at its home, the anchor next to it in each block, w bits away there.
* A pair with different homes differs, in each block where the homes do, by b - w - w' bits. So with
  the cost r + 1 - w of leaving home in a block, the costs of both, summed over the f blocks in which
  the homes differ, are at most RADIUS + f, and one of the two has at most half of it. Every
  fingerprint is therefore copied to all anchors that it reaches at a cost of (RADIUS + f) / 2 or
  less, and where it is exactly that, only to smaller anchors (the other one comes to this one if not).
* At an anchor all that came are compared with all that live there.

So every link is found at one anchor at least. ``b`` shrinks, and with it the share of an anchor,
as the number of fingerprints grows. An anchor with more than twice its fair share is cut into
cells, blocks of those that live there by blocks of those that came, so that a crowd of
like fingerprints is many small tasks. Within a cell links are merged at once, and only a tree of links
leaves it, never all pairs. Components of the trees are found by ``components``.

Null and empty texts have no words: their fingerprint is zero, linked like any other. A null id is
larger than any other; a component of null ids alone has a null component_id. Rows that repeat come
back as often as they are there. An empty table gives no rows. Columns but id and text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .common import documents, few, small, stored
from .components import components

SHINGLE, SEED, BITS, RADIUS = 3, 42, 64, 3
#: Block length by the number of fingerprints up to which it is used, so that an anchor is the home of
#: about 4,096 of them (beyond 2^33 fingerprints of more): 2^12 or 2^21 anchors, some 60 or 400 copies.
LENGTHS = ((5, 1 << 24), (3, 1 << 62))
#: The least sizes of a cell: fingerprints that live at the anchor, and those that came.
LIVE, CAME = 1024, 4096
#: Bytes of a text that are hashed at a time, up to the next white space.
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_LAST = (1 << 63) - 1


def features(text: bytes) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of a text, in order; piece by piece, so that memory does not follow its length."""
    at, last, n = 0, [], 0
    while at < len(text):
        gap = _SPACE.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        words = last + text[at:end].lower().split()  # bytes: A-Z only, and the six white-space bytes only
        n, at = max(n, len(words)), end
        last = words[1 - SHINGLE:]
        if len(words) >= SHINGLE:
            yield _hashed(words, SHINGLE)
    if 0 < n < SHINGLE:
        yield _hashed(last, n)


def _hashed(words: list[bytes], n: int) -> np.ndarray:
    joined = memoryview(b" ".join(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, digest = ends - sizes, xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:len(words) - n + 1].tolist(), ends[n - 1:].tolist())],
                    np.uint64)


def fingerprint(text: bytes) -> int:
    """The bits that more than half of the hashes have."""
    ones, n = np.zeros(BITS, np.int64), 0
    for h in features(text):
        n += len(h)
        for lo in range(0, len(h), 1 << 14):
            rows = h[lo:lo + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(rows, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(rank, fp) of every row of ``docs`` (doc_id, text); ``fp`` holds the 64 bits as a long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_buffers(batch.column("text"))
            out = np.array([fingerprint(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("rank"), pa.array(W.signed(out))], names=["rank", "fp"])

    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("rank")
    return docs.select(rank, "text").mapInArrow(run, "rank long, fp long")


def homes(fp: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """(home, w): the anchor of every fingerprint as a number, a bit for each block, and how many bits each
    block is away from it."""
    n, low = BITS // b, np.uint64((1 << b) - 1)
    ones = np.stack([np.bitwise_count((fp >> np.uint64(b * i)) & low) for i in range(n)], 1).astype(np.int8)
    far = 2 * ones > b
    home = (far.astype(np.int64) << np.arange(n)).sum(1)
    return home, np.where(far, b - ones, ones)


def copies(fp: np.ndarray, b: int, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, anchors): the anchors that the fingerprints go to, their homes first."""
    home, w = homes(fp, b)
    cost = (b - 1) // 2 + 1 - w.astype(np.int64)
    yield np.arange(len(fp)), home
    n = cost.shape[1]
    for f in range(1, min(radius, n) + 1):  # f blocks cost f at least: f <= (radius + f) / 2
        for flipped in combinations(range(n), f):
            twice = 2 * cost[:, flipped].sum(1)
            to = home ^ sum(1 << i for i in flipped)
            rows = np.flatnonzero((twice < radius + f) | ((twice == radius + f) & (to < home)))
            if len(rows):
                yield rows, to[rows]


def block_length(n: int) -> int:
    return next(b for b, most in LENGTHS if n <= most)


def crowded(nodes: DataFrame, b: int, n: int) -> dict[int, tuple[int, int]]:
    """The anchors with more than twice their fair share: into how many blocks their cells cut those that
    live there and those that came. There are fewer such anchors than twice the largest count of copies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for part in range(0, len(fp), 1 << 12):
                anchors, live, came = [], [], []
                for k, (rows, to) in enumerate(copies(fp[part:part + (1 << 12)], b)):
                    anchors.append(to)
                    live.append(np.full(len(rows), k == 0))
                to, at = np.unique(np.concatenate(anchors), return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to), pa.array(np.bincount(at, np.concatenate(live)).astype(np.int64)), pa.array(np.bincount(at))],
                    names=["anchor", "live", "came"])

    counts = stored(nodes.select("fp").mapInArrow(run, "anchor long, live long, came long").groupBy("anchor").agg(
        F.sum("live").alias("live"), F.sum("came").alias("came")), "anchors")
    total = counts.agg(F.sum("came")).first()[0] or 0
    live, came = (max(least, 2 * x // (1 << (BITS // b))) for least, x in ((LIVE, n), (CAME, total)))
    rows = counts.filter((F.col("live") > live) | (F.col("came") > came)).collect()
    return {r["anchor"]: (-(-r["live"] // live) or 1, -(-r["came"] // came)) for r in rows}


def cells(nodes: DataFrame, b: int, crowds: dict[int, tuple[int, int]]) -> DataFrame:
    """(anchor, cell, came, fp): the rows of every cell; those that live at the anchor have ``came`` false
    and come as well, once."""
    many = np.array(sorted(crowds), np.int64)
    cuts = np.array([crowds[a] for a in many.tolist()], np.int64).reshape(-1, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column("fp").to_numpy().view(np.uint64)
            for part in range(0, len(whole), 1 << 12):
                fp = whole[part:part + (1 << 12)]
                draw = W.mix(fp ^ np.uint64(0x2545F4914F6CDD1D))
                out: list[tuple[np.ndarray, ...]] = []
                for k, (rows, to) in enumerate(copies(fp, b)):
                    out.append((to, rows, np.ones(len(rows), bool)))
                    if k == 0:
                        out.append((to, rows, np.zeros(len(rows), bool)))
                to, rows, came = (np.concatenate(x) for x in zip(*out))
                if len(many):
                    at = np.minimum(np.searchsorted(many, to), len(many) - 1)
                    lives, comes = np.where((many[at] == to)[:, None], cuts[at], 1).T
                else:
                    lives, comes = np.ones((2, len(to)), np.int64)
                # one that lives there is in one block of its kind and meets all blocks of the other, and conversely
                own, other = np.where(came, comes, lives), np.where(came, lives, comes)
                mine = ((draw[rows] >> np.uint64(20)) % own.astype(np.uint64)).astype(np.int64)
                again = np.repeat(np.arange(len(to)), other)
                meets = np.arange(len(again)) - np.repeat(np.cumsum(other) - other, other)
                cell = np.where(came[again], meets * comes[again] + mine[again], mine[again] * comes[again] + meets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to[again]), pa.array(cell), pa.array(came[again]), pa.array(W.signed(fp[rows[again]]))],
                    names=["anchor", "cell", "came", "fp"])

    return nodes.select("fp").mapInArrow(run, "anchor long, cell long, came boolean, fp long")


class _Cell:
    """Those that live at an anchor, or a block of them, with the trees of the links found so far."""

    def __init__(self, key: tuple[int, int]):
        self.key, self.live, self.root = key, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.links: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, fp: np.ndarray) -> None:
        self.live = np.concatenate([self.live, fp])
        self.root = np.arange(len(self.live))

    def meet(self, fp: np.ndarray) -> None:
        """Compare those that came with all that live here; one link for each tree that one touches."""
        step = max(1, (1 << 20) // max(1, len(self.live)))
        for lo in range(0, len(fp) if len(self.live) else 0, step):
            part = fp[lo:lo + step]
            near = np.bitwise_count(part[:, None] ^ self.live[None, :]) <= RADIUS
            row, at = np.nonzero(near)
            keep = part[row] != self.live[at]
            row, at = row[keep], at[keep]
            # of each (row, tree) one link is enough
            _, first = np.unique(row * len(self.live) + self.root[at], return_index=True)
            row, at = row[first], at[first]
            self.links.append((part[row], self.live[at]))
            # the trees that a row touches become one
            root, start = self.root[at], {}
            for r, t in zip(row.tolist(), root.tolist()):
                start.setdefault(r, []).append(t)
            self._merge([t for t in start.values() if len(t) > 1])

    def _merge(self, groups: list[list[int]]) -> None:
        up: dict[int, int] = {}

        def find(x: int) -> int:
            while up.get(x, x) != x:
                up[x] = up.get(up[x], up[x])
                x = up[x]
            return x

        for group in groups:
            roots = {find(t) for t in group}
            least = min(roots)
            for t in roots:
                up[t] = least
        if up:
            to = np.arange(len(self.root))
            for t in up:
                to[t] = find(t)
            self.root = to[self.root]


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of rows sorted by (anchor, cell, came): a tree of each component of a cell."""
    now = _Cell((-1, -1))
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor, cell = (batch.column(c).to_numpy() for c in ("anchor", "cell"))
        came = batch.column("came").to_numpy(zero_copy_only=False)
        fp = batch.column("fp").to_numpy().view(np.uint64)
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (cell[1:] != cell[:-1]) | (came[1:] != came[:-1])])
        cuts = np.append(np.flatnonzero(new), len(fp))
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if (key := (int(anchor[lo]), int(cell[lo]))) != now.key:
                now = _Cell(key)
            if came[lo]:
                now.meet(fp[lo:hi])
                out, now.links = out + now.links, []
            else:
                now.add(fp[lo:hi])
        if out:
            a, b = (W.signed(np.concatenate(x)) for x in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of ``nodes`` (fp): those that connect all within RADIUS."""
    n = nodes.count()
    b = block_length(n)
    dealt = cells(nodes, b, crowded(nodes, b, n))
    parts = max(1, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return stored(dealt.repartition(parts, "anchor", "cell").sortWithinPartitions("anchor", "cell", "came")
                  .mapInArrow(_trees, "a long, b long"), "links", None)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text)."""
    rows = stored(fingerprints(docs), "fingerprints", None)
    nodes = stored(rows.groupBy("fp").agg(F.min("rank").alias("rank")), "nodes")
    roots = stored(components(links(nodes)), "roots")
    first = nodes.join(roots.withColumnRenamed("node", "fp"), "fp").groupBy("root").agg(F.min("rank").alias("first"))
    named = stored(roots.join(first, "root").select(F.col("node").alias("fp"), "first"), "named")
    own = stored(nodes.join(named, "fp", "left").select("fp", F.coalesce("first", "rank").alias("first")), "first")
    doc_id = lambda c: F.when(F.col(c) != _LAST, F.col(c))
    return few(rows.join(own, "fp")).select(doc_id("rank").alias("doc_id"), "fp", doc_id("first").alias("component_id"))


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
