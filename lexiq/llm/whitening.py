"""Whitening of embeddings by shifted CholeskyQR.

Every entry c of a vector becomes the whole number x = floor(64 c) + 1000000. With the exact sums S
over the n vectors, A is the tall matrix of the centred rows x - S/n. A pass over the rows sums, task
by task, the Gram matrix of the rows as they are after all triangular solves so far; the driver adds
these (dimension squared numbers), takes the Cholesky factor R of the sum, and the next pass solves
rows with R as well:

* pass 1 adds a small multiple of the identity (the shift), so that the factor exists however ill
  conditioned or singular A is;
* the next passes orthogonalise what is left; they go on until every eigenvalue of the Gram matrix is
  1 or 0 (no variance in that direction), and are shifted while the plain factor doesn't exist.

A = Q R with R the product of all factors, less the directions where the last Gram matrix has 0. The singular values s and right vectors of R are those of
A: component j is the j-th right vector, its eigenvalue of the covariance is s^2 / n. A last pass
projects and scales the rows, and sums the covariance of what comes out. Rows never meet in one
task; the driver holds matrices of the dimension only.

A row whose vector is null or holds a null or non-finite entry is left out. All vectors must have
one length: if lengths differ, the most frequent one counts (of equally frequent ones the larger)
and other rows are left out. Directions without variance (one vector, constant or dependent
entries) have no component, so fewer than ``COMPONENTS`` may come back; an empty table gives no
rows. Rows that repeat count, and come back, as often as they are there. A null id is kept. Columns
but the id and the vector are ignored. An entry of 2^44 or more is an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored
from .vectors import blocks, cells, summed, usable, whole

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: Passes end when the Gram matrix is this near to a projection; singular values below this share of
#: the largest are rounding, not variance.
NEAR, RANK, MAX_PASSES = 1e-11, 1e-12, 12


class Whitening(NamedTuple):
    """n, the sums S per dimension, component rows, their eigenvalues, and the trace of the covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def whole_rows(table: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> tuple[DataFrame, int]:
    """(vec_id, x) of the usable rows, stored, and their dimension."""
    kept = table.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("v")).filter(usable(F.col("v")))
    rows = stored(kept.select("vec_id", whole(F.col("v"), SCALE, SHIFT).alias("x")), "whole", None)
    sizes = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).head(1)
    dim = sizes[0]["dim"] if sizes else 0
    return rows.filter(F.size("x") == dim), dim


def totals(rows: DataFrame, dim: int) -> tuple[int, list[int]]:
    """(n, S): the number of rows and the exact sum of every dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(dim + 1, np.int64)
        for _, x in blocks(batches, "x", dim):
            seen[:dim] += x.sum(0)
            seen[dim] += len(x)
        yield cells(seen, "value")

    *sums, n = summed(rows.select("x").mapInArrow(run, "cell long, value long")
                      .withColumn("value", F.col("value").cast("decimal(38,0)")), "value", dim + 1)
    return int(n), [int(s) for s in sums]


def centre(sums: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The means S / n as whole parts and fractions, so that x less the mean loses no digits."""
    return (np.array([s // n for s in sums], np.int64), np.array([(s % n) / n for s in sums]))


def centred(x: np.ndarray, mean: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return (x - mean[0]).astype(np.float64) - mean[1]


def solve_rows(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Rows q with ``q @ factor = rows`` for an upper triangular factor, by forward substitution."""
    out = np.empty_like(rows)
    for j in range(factor.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def gram(rows: DataFrame, mean: tuple[np.ndarray, np.ndarray], factors: list[np.ndarray]) -> np.ndarray:
    """Sum over all rows of q' q, with q the centred row solved with every factor in turn."""
    dim = len(mean[0])
    upper = np.triu_indices(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((dim, dim))
        for _, x in blocks(batches, "x", dim):
            q = centred(x, mean)
            for factor in factors:
                q = solve_rows(q, factor)
            seen += q.T @ q
        yield cells(seen[upper], "value")

    out = np.zeros((dim, dim))
    out[upper] = summed(rows.select("x").mapInArrow(run, "cell long, value double"), "value", len(upper[0]))
    return np.triu(out) + np.triu(out, 1).T


def cholesky(g: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper factor R with R' R = g; with a shift if asked for, or if there is none without."""
    dim = len(g)
    shift = 11 * (dim * n + dim * (dim + 1)) * np.finfo(float).eps / 2 * np.trace(g)
    shift = max(min(shift, 1e-8 * np.trace(g)), np.finfo(float).tiny)
    for extra in ([] if shifted else [0.0]) + [shift * 10 ** i for i in range(8)]:
        try:
            return np.linalg.cholesky(g + extra * np.eye(dim)).T
        except np.linalg.LinAlgError:
            continue
    raise np.linalg.LinAlgError("no factor of the Gram matrix")


def fit(rows: DataFrame, dim: int, most: int = COMPONENTS) -> Whitening:
    """The whitening components of ``rows`` (x) of one dimension."""
    n, sums = totals(rows, dim) if dim else (0, [])
    none = Whitening(n, sums, np.zeros((0, dim)), np.zeros(0), 0.0)
    if not n:
        return none
    mean, factors = centre(sums, n), []
    while True:
        g = gram(rows, mean, factors)
        if not g.any():
            return none
        values, axes = np.linalg.eigh(g)
        if factors and np.all((abs(values - 1) < NEAR * dim) | (values < NEAR)) or len(factors) == MAX_PASSES:
            break
        factors.append(cholesky(g, n, not factors))
    # the last Gram matrix drops the directions that only the shifts have put into the factors
    r = np.sqrt(np.where(values < NEAR, 0, values))[:, None] * axes.T
    for factor in factors[::-1]:
        r = r @ factor
    _, s, right = np.linalg.svd(r)
    found = s > RANK * s[0]
    eigenvalues = (s * s / n)[found]
    return Whitening(n, sums, right[found][:most], eigenvalues[:most], float(eigenvalues.sum()))


def deviations(x: np.ndarray, sums: list[int], n: int) -> np.ndarray:
    """Sum over the dimensions of (n x - S)^2, exactly, as long; an error where it has more than 63 bits."""
    near, rest = x - np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)
    reach = float(n) * (float(np.abs(near).max(initial=0)) + 1)
    if reach * reach * len(sums) < 2 ** 62:
        apart = near * n - rest
        return (apart * apart).sum(1)
    apart = near.astype(object) * n - rest.astype(object)
    return np.array([int(v) for v in (apart * apart).sum(1)], np.int64)


def whiten(x: np.ndarray, model: Whitening) -> np.ndarray:
    return centred(x, centre(model.sums, model.n)) @ model.components.T / np.sqrt(model.eigenvalues)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    dim, k = len(model.sums), len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((k + 1, k))
        for _, x in blocks(batches, "x", dim):
            w = whiten(x, model)
            seen[:k] += w.T @ w
            seen[k] += w.sum(0)
        yield cells(seen, "value")

    got = np.array(summed(rows.select("x").mapInArrow(run, "cell long, value double"), "value", (k + 1) * k)).reshape(k + 1, k)
    mean = got[k] / model.n  # nothing but rounding: the rows were centred before
    return float(np.abs(got[:k] / model.n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, n, deviation, values) of every row; ``values`` has an entry for every component."""
    dim, vec_id = len(model.sums), rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in blocks(batches, "x", dim):
            values = whiten(x, model)
            ends = np.arange(0, values.size + 1, max(1, values.shape[1]), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(np.full(len(x), model.n)), pa.array(deviations(x, model.sums, model.n)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))],
                names=["vec_id", "n", "deviation", "values"])

    return rows.select("vec_id", "x").mapInArrow(run, f"vec_id {vec_id}, n long, deviation long, values array<double>")


def whitening(table: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", most: int = COMPONENTS) -> DataFrame:
    """A row for every usable row of ``table`` and every component: the columns of the module's text."""
    rows, dim = whole_rows(table, vector, vec_id)
    model = fit(rows, dim, most)
    kind = rows.schema["vec_id"].dataType.simpleString()
    if not len(model.eigenvalues):
        return rows.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, "
                                                     "whitened double, explained double, identity_error double")
    error, explained = identity_error(rows, model), (model.eigenvalues / model.trace).tolist()
    assert math.isfinite(error)
    out = whitened(rows, model).select("vec_id", "n", "deviation", F.posexplode("values").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
                      F.element_at(F.lit(explained), F.col("at") + 1).alias("explained"),
                      F.lit(error).alias("identity_error"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
