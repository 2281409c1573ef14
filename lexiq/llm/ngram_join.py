"""N-gram Jaccard self-join by a token-group matrix.

A document's tokens are its distinct 5-word shingles (64-bit hashes). Texts with the same token
set are one node. Two nodes link when 100 * intersection >= 80 * union; the result is the connected
component of every document.

Tokens are ordered globally, rare ones first. Rarity is read from ``BUCKETS`` counters over all
documents, a table of fixed size; any fixed order gives the same links. A node's prefix is its first
``n - ceil(0.8 n) + 1`` tokens: linked nodes share a token of their prefixes, and a pair that shares c
prefix tokens overlaps in at most ``c + max(n - p)`` tokens, with n and p the set and prefix sizes of
either side. Nodes whose prefix tokens occur nowhere else have no link and leave here.

1. First links. The other nodes are sorted by min-hashes of their tokens, ``ROUNDS`` times by different
   ones. Nodes that agree with one of the ``NEIGHBOURS`` nodes before them in ``AGREEING`` min-hashes
   are likely to have a link; they are sorted once more with their texts, and every one is compared
   by the full token sets with its neighbours and with the ``HUBS`` nodes nearby that have most links.
   Links found here already connect most near copies.
2. Matrix. Nodes with a token of another component are put in the order of their min-hashes, so similar
   ones are near each other; ``SUPER`` that follow each other are a supergroup, ``GROUP`` of its members a
   group. The union of a supergroup's prefix tokens is stored as rows (token, supergroup), by
   classes of set sizes (``CLASS_WIDTH`` wide), so members that are counted together are of like size.
3. Bound. Every node counts the tokens that it shares with a class as a whole; for the classes whose count
   allows a link with a member of some size between the smallest and the largest, those that it
   shares with each supergroup that holds a larger component. A token that many nodes have meets its
   few supergroups, not its many groups or components.
4. Qualifying supergroups are opened, the node's prefix tokens beside the members' in one task: it counts
   the tokens that the node shares with each group's union, opens the groups that qualify by the same
   rule, and does the same with their members of larger components. What is left, ids alone, is compared by
   the full token sets, group by group: a group's texts are read once, a node's text once per group.

A pair is skipped only if it is connected already or if the bound excludes it, so no component
is lost. A large group of near copies is connected in step 1, so it is not expanded into pairs. A
supergroup or group that very many nodes ask for is dealt to several tasks.

Null and empty texts have no tokens and link with nothing. A null id is larger than any other; a
component of null ids alone has a null component_id. Rows that repeat id and text are one
node. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .common import documents, few, small, stored, without
from .components import components

SHINGLE, PERCENT = 5, 80
BUCKETS, CLASS_WIDTH = 1 << 18, 1.006
MINHASHES, AGREEING, ROUNDS, NEIGHBOURS, HUBS, STRETCH = 9, 4, 3, 8, 4, 512
#: Members of a group and of a supergroup (a power of two); nodes that ask for one in one task.
GROUP, SUPER, ASKED = 24, 256, 2048
_LAST = (1 << 63) - 1
_SALTS = np.random.default_rng(7).integers(1, 1 << 62, MINHASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def token_sets(w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, bounds): the distinct tokens of document i, ascending, are ``tokens[bounds[i]:bounds[i + 1]]``."""
    hashes, doc = w.hashes(lower=True), w.doc_of_word()
    shingle, whole = W.grams(hashes, w.first, SHINGLE)
    at = np.flatnonzero(whole)
    short = np.flatnonzero((w.counts > 0) & (w.counts < SHINGLE))
    # a shorter text is one token: its whole word sequence
    ones = []
    for d in short:
        h = hashes[w.first[d]:w.first[d + 1]]
        powers = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(len(h))], np.uint64)
        ones.append(W.mix(np.array([(h * powers).sum()], np.uint64) + np.uint64(len(h)))[0])
    tokens = np.concatenate([shingle[at], np.array(ones, np.uint64)])
    owner = np.concatenate([doc[at], short])
    order = np.argsort(tokens, kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    tokens, owner = tokens[order], owner[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    return tokens[new], np.searchsorted(owner[new], np.arange(w.n_docs + 1))


def node_ids(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64-bit hash of every token set."""
    sums = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(W.mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1:])
    return W.signed(W.mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64)))


def min_hashes(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MINHASHES values for every document; zeros for an empty one."""
    out = np.zeros((len(bounds) - 1, MINHASHES), np.uint64)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        for i, salt in enumerate(_SALTS):
            out[full, i] = np.minimum.reduceat(W.mix(tokens * salt), bounds[full])
    return W.signed(out)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for w in W.slices(batch.column(0)):
            seen += np.bincount(_bucket(token_sets(w)[0]), minlength=BUCKETS)
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["bucket", "n"])


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def rarity(docs: DataFrame) -> np.ndarray:
    """Tokens of all documents per bucket; BUCKETS numbers."""
    rows = (docs.select("text").mapInArrow(_counted, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(BUCKETS, np.int64)
    out[rows.bucket] = rows.n
    return out


def sketch(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """(rank, node, n, mins, prefix) of every document; node is null without a token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in W.slices(batch.column("text")):
                tokens, bounds = token_sets(w)
                n = np.diff(bounds)
                owner = np.repeat(np.arange(w.n_docs), n)
                order = np.argsort(counts[_bucket(tokens)], kind="stable")
                order = order[np.argsort(owner[order], kind="stable")]
                keep = np.where(n > 0, n - (PERCENT * n + 99) // 100 + 1, 0)
                early = np.arange(len(tokens)) - np.repeat(bounds[:-1], n) < np.repeat(keep, n)
                ends = np.zeros(w.n_docs + 1, np.int32)
                np.cumsum(keep, out=ends[1:])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rank").slice(w.row, w.n_docs),
                     pa.array(node_ids(tokens, bounds), mask=n == 0), pa.array(n), _rows(min_hashes(tokens, bounds)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(W.signed(tokens[order][early])))],
                    names=["rank", "node", "n", "mins", "prefix"])

    return docs.select("rank", "text").mapInArrow(
        run, "rank long, node long, n long, mins array<long>, prefix array<long>")


def _rows(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)),
                                    pa.array(values.ravel()))


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, node) those whose token has two nodes, each once; and the first and the
    last token of the partition, which may go on in the next."""
    names = ["token", "node", "n"]
    held, many, first = None, True, True  # the open run's last row, and whether its rows were passed on
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(c).to_numpy() for c in names]
        if held is not None:
            rows = [np.concatenate([[h], r]) for h, r in zip(held, rows)]
        token, node, _ = rows
        starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
        two = np.add.reduceat(new, starts) > 1
        two[0] |= many if held is not None else first
        keep = np.repeat(two, np.diff(np.append(starts, len(token)))) & new
        if held is not None and many:
            keep[0] = False  # was passed on with the batch before
        held, many, first = [r[-1] for r in rows], bool(two[-1]), False
        at = np.flatnonzero(keep)
        yield pa.RecordBatch.from_arrays([pa.array(r[at]) for r in rows], names=names)
    if held is not None and not many:
        yield pa.RecordBatch.from_arrays([pa.array([h]) for h in held], names=names)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two ascending token sets reach the threshold."""
    small_, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small_) < PERCENT * len(large):
        return False
    at = np.searchsorted(large, small_)
    both = int((large[np.minimum(at, len(large) - 1)] == small_).sum())
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, mins, text) of the rows whose text is of the node (ids may repeat)."""
    for batch in batches:
        node = batch.column("node").to_numpy()
        for w in W.slices(batch.column("text")):
            tokens, bounds = token_sets(w)
            same = np.flatnonzero(node_ids(tokens, bounds) == node[w.row:w.row + w.n_docs])
            at = pa.array(same + w.row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(at), _rows(min_hashes(tokens, bounds)[same]), batch.column("text").take(at)],
                names=["node", "mins", "text"])


def _alike(first: int):
    """Nodes with a row shortly before them that agrees in many min-hashes, and those rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for batch in batches:
            node, n = (batch.column(c).to_numpy() for c in ("node", "n"))
            mins = batch.column("mins").values.to_numpy().reshape(-1, MINHASHES)
            if tail is not None:
                node, n, mins = (np.concatenate(x) for x in zip(tail, (node, n, mins)))
            found = np.zeros(len(node), bool)
            for back in range(1, min(NEIGHBOURS, len(node) - 1) + 1):
                near = ((mins[back:, first] == mins[:-back, first]) & (node[back:] != node[:-back])
                        & ((mins[back:] == mins[:-back]).sum(1) >= AGREEING)
                        & (100 * np.minimum(n[back:], n[:-back]) >= PERCENT * np.maximum(n[back:], n[:-back])))
                found[back:] |= near
                found[:-back] |= near
            tail = (node[-NEIGHBOURS:], n[-NEIGHBOURS:], mins[-NEIGHBOURS:])
            yield pa.RecordBatch.from_arrays([pa.array(node[found])], names=["node"])
    return run


class _Run:
    """Rows of one min-hash, in their order: each is compared with the NEIGHBOURS before it and with
    the HUBS rows that had most links so far; at the end of a stretch, with the stretch's hubs."""

    def __init__(self, key: int):
        self.key, self.recent, self.hubs, self.stretch = key, deque(maxlen=NEIGHBOURS), [], []
        self.links = []

    def add(self, node: int, tokens: np.ndarray) -> None:
        mine = {"node": node, "tokens": tokens, "degree": 0, "met": set()}
        for other in {x["node"]: x for x in [*self.recent, *self.hubs]}.values():
            self._meet(mine, other)
        self.recent.append(mine)
        self.stretch.append(mine)
        self.hubs = sorted([*self.recent, *(h for h in self.hubs if all(h is not r for r in self.recent))],
                           key=lambda x: -x["degree"])[:HUBS]
        if len(self.stretch) >= STRETCH:
            self.close()

    def _meet(self, mine: dict, other: dict) -> None:
        mine["met"].add(other["node"])
        if linked(other["tokens"], mine["tokens"]):
            self.links.append((mine["node"], other["node"]))
            mine["degree"] += 1
            other["degree"] += 1

    def close(self) -> None:
        for hub in list(self.hubs):
            for row in self.stretch:
                if row is not hub and hub["node"] not in row["met"] and row["node"] not in hub["met"]:
                    self._meet(row, hub)
        self.stretch = []


def _neighbours(first: int):
    """Links (a, b) that the runs of equal min-hashes find."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def drawn() -> pa.RecordBatch:
            out, now.links = now.links, []
            return pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64())], names=["a", "b"])

        now = _Run(0)
        for batch in batches:
            node = batch.column("node").to_numpy()
            mins = batch.column("mins").values.to_numpy().reshape(-1, MINHASHES)[:, first]
            for w in W.slices(batch.column("text")):
                tokens, bounds = token_sets(w)
                for i in range(w.n_docs):
                    if mins[w.row + i] != now.key:
                        now.close()
                        yield drawn()
                        now = _Run(mins[w.row + i])
                    now.add(int(node[w.row + i]), tokens[bounds[i]:bounds[i + 1]])
        now.close()
        yield drawn()
    return run


class _Matrix:
    """The members of an opened supergroup: their tokens, and the union of each GROUP of them."""

    def __init__(self, rows: list[dict]):
        self.rows = rows
        self.node, self.n, self.comp, self.size = (np.array([r[c] for r in rows], np.int64)
                                                   for c in ("node", "n", "comp", "comp_size"))
        tokens = [np.unique(np.array(r["tokens"], np.int64)) for r in rows]
        self.token = np.concatenate(tokens)
        self.member = np.repeat(np.arange(len(rows)), [len(t) for t in tokens])
        order = np.argsort(self.token, kind="stable")
        self.token, self.member = self.token[order], self.member[order]
        first = np.ones(len(order), bool)
        first[1:] = (self.token[1:] != self.token[:-1]) | (self.member[1:] // GROUP != self.member[:-1] // GROUP)
        self.union, self.group = self.token[first], self.member[first] // GROUP
        starts = np.arange(0, len(rows), GROUP)
        self.n_min, self.n_max = np.minimum.reduceat(self.n, starts), np.maximum.reduceat(self.n, starts)

    @staticmethod
    def shared(token: np.ndarray, owner: np.ndarray, asked: np.ndarray, n: int) -> np.ndarray:
        """Per owner, how many of the asked tokens (ascending, distinct) it has."""
        lo, hi = np.searchsorted(token, asked), np.searchsorted(token, asked, "right")
        count = hi - lo
        at = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(count.sum())
        return np.bincount(owner[at], minlength=n)

    def candidates(self, row: dict) -> Iterator[tuple[int, np.ndarray]]:
        """(first member of a group, places of members) that the row's node may link with, of larger components."""
        n, asked = row["n"], np.unique(np.array(row["tokens"], np.int64))
        least, most = -(-PERCENT * n // 100), 100 * n // PERCENT
        low, high = np.maximum(self.n_min, least), np.minimum(self.n_max, most)
        enough = np.minimum(np.minimum(_needed(n, low), _needed(n, np.maximum(low, high - 1))), _needed(n, high))
        opened = (low <= high) & (self.shared(self.union, self.group, asked, len(low)) >= enough)
        if not opened.any():
            return
        fits = ((self.n >= least) & (self.n <= most) & opened[np.arange(len(self.n)) // GROUP]
                & ((self.size > row["comp_size"]) | ((self.size == row["comp_size"]) & (self.comp > row["comp"]))))
        if fits.any():
            at = np.flatnonzero(fits & (self.shared(self.token, self.member, asked, len(fits)) >= _needed(n, self.n)))
            for group in np.unique(at // GROUP):
                yield int(self.node[group * GROUP]), at[at // GROUP == group]


def _needed(n: int, size: np.ndarray) -> np.ndarray:
    """As ``needed``, for arrays."""
    share = lambda x: -(-PERCENT * x // 100)
    return -(-PERCENT * (n + size) // (100 + PERCENT)) - np.maximum(share(n), share(size)) + 1


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(unit, asks, a, bs, comps) of rows sorted by (sg, cls, to_cls, salt, asks): a supergroup's members, then the
    nodes that ask for it. ``unit`` is the first member of the group that ``bs``, of ``comps``, are of. A row that
    doesn't ask has all members of the unit that some node of the cell has to be compared with."""
    key, members, matrix = None, [], None
    wanted: dict[int, set[int]] = {}

    def drawn(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                                          names=["unit", "asks", "a", "bs", "comps"])

    def named(unit: int, node: int | None, at: list[int]) -> tuple:
        return unit, node is not None, node, matrix.node[at].tolist(), matrix.comp[at].tolist()

    for batch in batches:
        out: list[tuple] = []
        for row in batch.to_pylist():
            now = (row["sg"], row["cls"], row["to_cls"], row["salt"])
            if now != key:
                out += [named(unit, None, sorted(at)) for unit, at in wanted.items()]
                key, members, matrix, wanted = now, [], None, {}
            if not row["asks"]:
                members.append(row)
                continue
            matrix = matrix or _Matrix(members)
            for unit, at in matrix.candidates(row):
                wanted.setdefault(unit, set()).update(at.tolist())
                out.append(named(unit, row["node"], at.tolist()))
        yield drawn(out)
    yield drawn([named(unit, None, sorted(at)) for unit, at in wanted.items()])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of rows sorted by (unit, salt, asks): a group's members, then the nodes to compare with them.
    One link of a node with a component is enough."""
    key, members = None, {}
    for batch in batches:
        links: list[tuple[int, int]] = []
        unit, salt, asks, node, bs, comps = (batch.column(c).to_pylist() for c in ("unit", "salt", "asks", "node", "bs", "comps"))
        for w in W.slices(batch.column("text")):
            tokens, bounds = token_sets(w)
            for i in range(w.n_docs):
                at, mine = w.row + i, tokens[bounds[i]:bounds[i + 1]]
                if (unit[at], salt[at]) != key:
                    key, members = (unit[at], salt[at]), {}
                if asks[at]:
                    joined: set[int] = set()
                    for b, comp in zip(bs[at], comps[at]):
                        if comp not in joined and linked(mine, members[b]):
                            joined.add(comp)
                            links.append((node[at], b))
                else:
                    members[node[at]] = mine.copy()
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())],
                                         names=["a", "b"])


def needed(n: Column, size: Column) -> Column:
    """Prefix tokens that a set of ``n`` must share with one of ``size`` to link; see the module's text."""
    overlap = F.ceil(F.lit(float(PERCENT)) * (n + size) / (100 + PERCENT) - 1e-9)
    rest = lambda x: F.ceil(F.lit(float(PERCENT)) * x / 100 - 1e-9) - 1
    return overlap - F.greatest(rest(n), rest(size))


def least_needed(n: Column, low: Column, high: Column) -> Column:
    """The smallest ``needed(n, size)`` of all sizes from ``low`` to ``high``. Up to n it grows with size.
    Above, it falls by 4/5 and grows by 4/9 a size, each rounded up, so k sizes less change it by
    floor(4k/5) - ceil(4k/9) or more: only the size before the last can need fewer than the last."""
    return F.least(needed(n, low), needed(n, F.greatest(low, high - 1)), needed(n, high))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, node, kept) of every row of ``docs`` (doc_id, text). ``node``
    stands for the token set; ``kept`` marks the rows of a component's first id and token set."""
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("rank")
    texts = docs.select(rank, "text")
    rows = stored(sketch(texts, rarity(texts)), "sketch", None)
    prefixes = rows.filter("n > 0").select(F.explode("prefix").alias("token"), "node", "n")
    tokens = stored(prefixes.repartitionByRange("token", "node").sortWithinPartitions("token", "node")
                    .mapInArrow(_shared, "token long, node long, n long"), "tokens")
    heads = rows.filter("n > 0").groupBy("node", "n", "mins").agg(F.min("rank").alias("rank"))
    heads = stored(heads.join(tokens.select("node").distinct(), "node"), "heads")

    def texts_of(nodes: DataFrame) -> DataFrame:
        """(node, mins, text) of one document per node."""
        wanted = stored(heads.select("node", "rank").join(nodes.select("node").distinct(), "node"), "wanted")
        return stored(texts.join(small(wanted), "rank").select("node", "text")
                      .mapInArrow(_matched, "node long, mins array<long>, text string"), "texts", 8)

    # 1. sorted neighbours: the nodes with a likely link, links between them, groups, first components
    def sorted_by(df: DataFrame, r: int, *last: str) -> DataFrame:
        keys = [F.col("mins")[(r * MINHASHES // ROUNDS + i) % MINHASHES] for i in range(MINHASHES // ROUNDS)]
        order = [*keys, *[F.col(c) for c in last], F.col("node")]
        return df.repartitionByRange(*order).sortWithinPartitions(*order)

    near, found = None, None
    for r in range(ROUNDS):
        alike = sorted_by(heads, r, "n").select("node", "n", "mins").mapInArrow(
            _alike(r * MINHASHES // ROUNDS), "node long")
        near = alike if near is None else near.union(alike)
    near = texts_of(near)
    for r in range(ROUNDS):
        links = sorted_by(near.withColumn("n", F.length("text")), r, "n").select("node", "mins", "text").mapInArrow(
            _neighbours(r * MINHASHES // ROUNDS), "a long, b long")
        found = links if found is None else found.union(links)
    first = components(stored(found, "neighbours"))
    sizes = first.groupBy("root").agg(F.count(F.lit(1)).alias("comp_size"))
    labels = stored(tokens.select("node", "n").distinct().join(first.join(sizes, "root"), "node", "left").select(
        "node", "n", F.coalesce("root", "node").alias("comp"), F.coalesce("comp_size", F.lit(1)).alias("comp_size")), "labels")

    # 2. matrix: tokens that occur in two components or more, by size class and by supergroup
    placed = tokens.select("token", "node").join(labels, "node")
    several = (placed.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
               .filter("lo <> hi").select("token"))
    placed = stored(placed.join(several, "token").withColumn(
        "cls", F.floor(F.log(F.col("n").cast("double")) / math.log(CLASS_WIDTH)).cast("int")), "placed")
    least_, most = F.ceil(PERCENT * F.col("n") / 100 - 1e-9), F.floor(100 * F.col("n") / PERCENT + 1e-9)
    fits = (F.col("n_max") >= least_) & (F.col("n_min") <= most)
    enough = least_needed(F.col("n"), F.greatest(F.col("n_min"), least_), F.least(F.col("n_max"), most))

    # 3. bound, first against size classes as a whole, then against the supergroups of qualifying classes
    classes = placed.groupBy("token", "cls").agg(
        F.min("n").alias("n_min"), F.max("n").alias("n_max"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    asked = (placed.select("token", "node", "n", "comp").join(classes, "token")
             .filter(fits & ((F.col("lo") != F.col("comp")) | (F.col("hi") != F.col("comp")))))
    open_classes = (asked.groupBy("node", "n", "cls").agg(
        F.count(F.lit(1)).alias("c"), F.min("n_min").alias("n_min"), F.max("n_max").alias("n_max"))
        .filter(F.col("c") >= enough).select("node", F.col("cls").alias("to_cls")))
    # a link needs both sides: the node open to the member's class, the member to the node's class
    open_classes = stored(open_classes, "open_classes")
    order = sorted_by(heads.select("node", "n", "mins").join(open_classes.select("node").distinct(), "node"), 0, "n")
    order = stored(order.select("node", F.monotonically_increasing_id().alias("place")), "order")
    rank_ = F.struct("comp_size", "comp")
    willing = stored(placed.join(open_classes, "node").join(order, "node").withColumn(
        "sg", F.shiftright("place", SUPER.bit_length() - 1)), "willing")
    matrix = willing.groupBy("token", "cls", "to_cls", "sg").agg(F.max(rank_).alias("top")).select(
        "token", F.col("cls").alias("to_cls"), F.col("to_cls").alias("cls"), "sg", "top")
    spans = willing.groupBy("sg", F.col("cls").alias("to_cls"), F.col("to_cls").alias("cls")).agg(
        F.min("n").alias("n_min"), F.max("n").alias("n_max"))
    asked = (willing.select("token", "node", "n", "comp", "comp_size", "cls", "to_cls")
             .join(matrix, ["token", "cls", "to_cls"]).filter(rank_ < F.col("top"))
             .groupBy("node", "n", "sg", "cls", "to_cls").agg(F.count(F.lit(1)).alias("c")))
    opened = stored(asked.join(spans, ["sg", "cls", "to_cls"]).filter(fits & (F.col("c") >= enough))
                    .select("node", "sg", "cls", "to_cls"), "opened")

    # 4. opened supergroups, their groups and members; a supergroup is named by its members' class, cls
    sets = placed.groupBy("node", "n", "comp", "comp_size").agg(F.collect_list("token").alias("tokens"))
    sets = stored(sets.join(order, "node"), "sets")
    cell = ["sg", "cls", "to_cls"]
    asking = opened.select("sg", F.col("to_cls").alias("cls"), F.col("cls").alias("to_cls"), "node")
    salts = stored(asking.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / ASKED).alias("salts")), "salts")
    own = F.pmod(F.xxhash64("node"), F.col("salts"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))
    members = willing.select(*cell, "node").distinct().join(salts, cell)
    both = (members.select(*cell, every.alias("salt"), F.lit(False).alias("asks"), "node")
            .union(asking.join(salts, cell).select(*cell, own.alias("salt"), F.lit(True), "node")).join(sets, "node"))
    keys = [*cell, "salt"]
    ranges = _dealt(both, keys, ["asks", "place"]).select(*keys, "asks", "node", "n", "comp", "comp_size", "tokens")
    opened = stored(ranges.mapInArrow(_opened, "unit long, asks boolean, a long, bs array<long>, comps array<long>"), "pairs")

    # what is left is compared by the full token sets
    asking = opened.filter("asks").select("unit", F.col("a").alias("node"), "bs", "comps")
    salts = stored(asking.groupBy("unit").agg(F.ceil(F.count(F.lit(1)) / ASKED).alias("salts")), "salts")
    none = F.lit(None).cast("array<long>")
    members = opened.filter("NOT asks").select("unit", F.explode("bs").alias("node")).distinct().join(salts, "unit").select(
        "unit", every.alias("salt"), F.lit(False).alias("asks"), "node", none.alias("bs"), none.alias("comps"))
    both = members.union(asking.join(salts, "unit").select("unit", own.alias("salt"), F.lit(True), "node", "bs", "comps"))
    both = both.join(texts_of(both.select("node")).select("node", "text"), "node")
    checked = _dealt(both, ["unit", "salt"], ["asks"]).select("unit", "salt", "asks", "node", "bs", "comps", "text").mapInArrow(
        _verified, "a long, b long")
    links = stored(first.select(F.col("node").alias("a"), F.col("root").alias("b")).union(checked), "links")

    roots = components(links)
    noted = rows.select("rank", "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = noted.filter("n > 0").groupBy("root").agg(F.min(F.struct("rank", "node")).alias("head"))
    doc_id = lambda c: F.when(F.col(c) != _LAST, F.col(c))
    alone = F.col("head").isNull()
    return few(noted.join(heads, "root", "left")).select(
        doc_id("rank").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(alone, doc_id("rank")).otherwise(doc_id("head.rank")).alias("component_id"), "node",
        (alone | ((F.col("rank") == F.col("head.rank")) & (F.col("node") == F.col("head.node")))).alias("kept"))


def _dealt(rows: DataFrame, keys: list[str], then: list[str]) -> DataFrame:
    """Rows of equal keys together in one partition, in the order of keys and ``then``."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *keys).sortWithinPartitions(*keys, *then)


def with_node(docs: DataFrame) -> DataFrame:
    """``docs`` with the column ``node`` of ``near_duplicates``."""
    docs = without(docs, ["node"])
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [(np.diff(bounds), node_ids(tokens, bounds)) for w in W.slices(batch.column("text"))
                     for tokens, bounds in [token_sets(w)]]
            n, nodes = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(nodes, mask=n == 0)],
                                             names=[*names, "node"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("node", T.LongType())]))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents of each component but its first by id. Documents without
    words are components of their own; of rows that repeat id and token set one stays."""
    found = stored(near_duplicates(docs), "components")
    gone = stored(found.filter(~F.col("kept")).select("doc_id", "node").distinct(), "gone")
    again = stored(found.filter("kept AND node IS NOT NULL").groupBy("doc_id", "node").count()
                   .filter("count > 1").select("doc_id", "node"), "again")
    marked = with_node(docs)
    left = marked.alias("d")

    def same(other: DataFrame) -> Column:
        return left["doc_id"].eqNullSafe(other["doc_id"]) & (left["node"] == other["node"])

    rest = left.join(small(gone), same(gone), "left_anti")
    if again.count():
        left = rest.alias("d")
        twice = left.join(small(again), same(again), "left_semi").dropDuplicates(["doc_id", "node"])
        rest = left.join(small(again), same(again), "left_anti").union(twice)
    return rest.drop("node")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).drop("node")
