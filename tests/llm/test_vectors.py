"""Centroid clustering and whitening against direct computation."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from lexiq.llm import centroids, whitening
from lexiq.llm.vectors import usable

ROWS = "vec_id long, embedding array<float>, label int, x string, component int, cluster string"
NAN, INF = float("nan"), float("inf")


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v if v is None else [None if e is None else float(e) for e in v], 1, "x", 2, None)
                                  for i, v in zip(ids, vectors)], ROWS).repartition(3)


def mixed(dim: int, n: int, seed: int) -> list:
    rng = np.random.default_rng(seed)
    rows = (rng.normal(size=(n, dim)) * np.linspace(0.1, 0.5, dim)).astype(np.float32).tolist()
    rows += [rows[0]] * 5 + [rows[1]] * 3
    bad = [list(rows[2]) for _ in range(4)]
    bad[0][0], bad[1][dim - 1], bad[2][1], bad[3][0] = None, NAN, INF, -INF
    return [*rows, *bad, None, [], rows[3][:-1]]


# --- threshold algorithm -------------------------------------------------------------------

@pytest.mark.parametrize("reach", [2, 40])
def test_nearest_is_the_smallest_number_of_the_smallest_distance(reach):
    rng = np.random.default_rng(reach)
    x, c = rng.integers(-reach, reach, (500, 6)), rng.integers(-reach, reach, (30, 6))
    c[7], c[20] = c[3], c[3]
    number, distance = centroids.nearest(x, c)
    full = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (number == full.argmin(1)).all() and (distance == full.min(1)).all()


def brute_clusters(rows: list[tuple[int | None, list]], k: int, rounds: int):
    """(id, cluster, distance, cluster inertia, inertia, digest) of every row, with Python's whole numbers."""
    kept = [(i, tuple(int(np.floor(256 * float(e))) for e in v)) for i, v in rows]
    key = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    c = [v for _, v in sorted(kept, key=key)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, x)), j) for j, x in enumerate(c))
    for _ in range(rounds):
        groups: dict[int, list] = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        c = [tuple(sum(col) // len(groups[j]) for col in zip(*groups[j])) if j in groups else x for j, x in enumerate(c)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    per = {j: sum(d for _, g, d in found if g == j) for j in range(len(c))}
    return sorted(((i, j, d, per[j], sum(per.values()), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest())
                   for i, j, d in found), key=str)


@pytest.mark.parametrize("n, k", [(60, 7), (4, 9)])
def test_clusters_match_brute_force(spark, n, k):
    vectors = mixed(6, n, 1)
    ids = [None if i == 3 else i for i in range(len(vectors))]
    kept = [(i, v) for i, v in zip(ids, vectors) if v and len(v) == 6 and all(e is not None and np.isfinite(e) for e in v)]
    got = centroids.clustered(table(spark, vectors, ids), k=k, rounds=5, dim=6).collect()
    assert sorted(map(tuple, got), key=str) == brute_clusters(kept, k, 5)


def test_clusters_of_no_rows(spark):
    for rows in ([], [None, [1.0], [NAN] * 64]):
        out = centroids.clustered(table(spark, rows))
        assert out.collect() == []
        assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_huge_entries_are_an_error(spark):
    with pytest.raises(Exception, match="too large for exact"):
        centroids.clustered(table(spark, [[1e9] * 64])).collect()
    with pytest.raises(Exception, match="too large for exact"):
        whitening.whitening(table(spark, [[1e30, 1.0], [0.0, 1.0]])).collect()


def test_usable(spark):
    rows = table(spark, [[1.0, 2.0], None, [None, 1.0], [NAN], [INF], [-INF, 0.0], []])
    assert [r.vec_id for r in rows.filter(usable(rows["embedding"])).orderBy("vec_id").collect()] == [0, 6]


# --- whitening -----------------------------------------------------------------------------

def check_whitening(spark, vectors, dim, most=32, rank=None):
    kept = {i: v for i, v in enumerate(vectors) if v and len(v) == dim and all(e is not None and np.isfinite(e) for e in v)}
    x = np.floor(64 * np.array(list(kept.values()), np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    a = x - sums / n
    values, axes = np.linalg.eigh(a.T @ a / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(most, rank or dim)
    got = whitening.whitening(table(spark, vectors), most=most).toPandas()
    assert len(got) == k * n and set(got.component) == set(range(1, k + 1)) and (got.n == n).all()
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[list(kept)].to_numpy()
    want = a @ axes[:, :k] / np.sqrt(values[:k])
    assert np.abs(wide * np.sign((wide * want).sum(0)) - want).max() < 1e-8
    assert np.allclose(got.groupby("component").explained.first(), values[:k] / values.sum(), rtol=1e-9)
    assert (got.groupby("vec_id").deviation.first()[list(kept)] == ((n * x - sums) ** 2).sum(1)).all()
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    assert got.identity_error[0] == pytest.approx(np.abs(wide.T @ wide / n - np.eye(k)).max(), abs=1e-10)


def test_whitening_matches_the_eigenvectors(spark):
    check_whitening(spark, mixed(8, 200, 2), 8)
    check_whitening(spark, mixed(40, 300, 3), 40)


def test_whitening_of_dependent_and_ill_conditioned_entries(spark):
    """A constant and a doubled entry have no component of their own; scales from 0.02 to 4096 are kept apart."""
    rng = np.random.default_rng(5)
    base = rng.integers(-90, 90, (300, 4)) / 64 * np.array([1, 8, 64, 2048])
    rows = np.column_stack([base, np.full(300, 2.5), base[:, 0]]).tolist()
    check_whitening(spark, rows, 6, rank=4)


def test_whitening_without_variance(spark):
    for vectors in ([], [None, [NAN, 1.0]], [[1.0, 2.0]], [[0.5, 0.25]] * 4):
        out = whitening.whitening(table(spark, vectors))
        assert out.collect() == []
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_solve_rows_and_exact_deviations():
    rng = np.random.default_rng(6)
    r = np.triu(rng.normal(size=(5, 5))) + 3 * np.eye(5)
    q = rng.normal(size=(9, 5))
    assert np.allclose(whitening.solve_rows(q @ r, r), q)
    x = np.array([[1_000_000, 999_000], [1_300_000, 5]])
    for n, sums in ((2, x.sum(0).tolist()), (2000, [x[0, 0] * 2000 - 77, x[0, 1] * 2000 + 5])):
        assert whitening.deviations(x, sums, n).tolist() == [sum((n * int(e) - int(s)) ** 2 for e, s in zip(row, sums)) for row in x]
    with pytest.raises(OverflowError):
        whitening.deviations(np.array([[1_000_000_000_000]]), [0], 10_000_000_000)
