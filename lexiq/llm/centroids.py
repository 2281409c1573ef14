"""Centroid clustering (k-means rounds) whose nearest centroid is found by the threshold algorithm.

Vectors are whole numbers floor(256 x). For every dimension the k centroids are kept as a list sorted
by their value there. From a vector's own value each list is walked outward: the next centroid is the
nearer one of the two that lie next below and above what was seen. A centroid that a walk meets for
the first time gets its exact squared distance. The frontier of a dimension is the squared distance,
there, of the centroid seen last; a centroid that no walk has met is at least as far away as the sum
of the frontiers. So a vector's walk stops when that sum strictly exceeds the best exact distance
(equal ones are still met, and the smaller number wins), or when all centroids were met.

Each round is one pass over the stored vectors: tasks assign their rows in blocks and give back the
exact sums and counts per centroid, k times the dimension numbers, which Spark adds up. Centroids,
of that size too, are all that the driver holds; a centroid with a third of all vectors is a sum
like any other.

Kept are vectors with exactly ``dim`` entries, none null or non-finite. The first centroids are the k
kept vectors with the smallest sha256 of ``2:<vec_id>``, ties by their entries; a null id comes last.
With fewer than k kept vectors there are as many centroids. Rows that repeat count, and come back,
as often as they are there, and equal centroids leave the rows to the smallest number. An empty
table gives no rows. Columns but the id and the vector are ignored. An entry of 2^19 or more is
an error: squared distances would not be exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored
from .vectors import blocks, cells, summed, usable, whole

K, ROUNDS, DIM, SCALE = 40, 5, 64, 256
#: With entries below this, squared distances of up to 2^8 dimensions fit a long.
LARGEST = 1 << 27


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of every row of ``x``, by the threshold algorithm."""
    k, dim = centroids.shape
    order = np.argsort(centroids, axis=0, kind="stable").T  # per dimension: centroid numbers by value
    values = np.take_along_axis(centroids.T, order, 1)
    best, found = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), k, np.int64)
    live, dims = np.arange(len(x)), np.arange(dim)
    seen = np.zeros((len(x), k), bool)
    # the next centroid below and above the vector's value, per dimension
    above = np.stack([np.searchsorted(values[d], x[:, d]) for d in range(dim)], 1) if len(x) else np.zeros((0, dim), np.int64)
    below = above - 1
    far = np.iinfo(np.int64).max
    while len(live):
        v = x[live]
        down, up = below[live], above[live]
        gap_down = np.where(down >= 0, v - values[dims, np.maximum(down, 0)], far)
        gap_up = np.where(up < k, values[dims, np.minimum(up, k - 1)] - v, far)
        lower = gap_down <= gap_up
        at = np.where(lower, down, up)
        below[live], above[live] = down - lower, up + ~lower
        met = np.zeros((len(live), k), bool)
        np.put_along_axis(met, order[dims, at], True, 1)
        met &= ~seen[live]
        rows, numbers = np.nonzero(met)
        step = max(1, (1 << 20) // dim)
        for lo in range(0, len(rows), step):  # ascending numbers within a row
            r, c = rows[lo:lo + step], numbers[lo:lo + step]
            apart = v[r] - centroids[c]
            distance = (apart * apart).sum(1)
            # the smallest (distance, number) of each row of this step
            first = np.lexsort((c, distance, r))
            first = first[np.concatenate([[True], r[first][1:] != r[first][:-1]])]
            to, d, c = live[r[first]], distance[first], c[first]
            better = (d < best[to]) | ((d == best[to]) & (c < found[to]))
            best[to[better]], found[to[better]] = d[better], c[better]
        seen[live] |= met
        gap = np.where(lower, gap_down, gap_up)
        frontier = (gap * gap).sum(1)
        live = live[(frontier <= best[live]) & ~seen[live].all(1)]
    return found, best


def whole_rows(table: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", dim: int = DIM) -> DataFrame:
    """(vec_id, x) of the kept rows, stored."""
    v = F.col("v")
    kept = (table.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("v"))
            .filter((F.size(v) == dim) & usable(v)))
    x = whole(v, SCALE, 0)
    exact = F.transform(x, lambda e: F.when(F.abs(e) < LARGEST, e).otherwise(
        F.raise_error(F.concat(F.lit("entry too large for exact distances: "), e.cast("string")))))
    return stored(kept.select("vec_id", exact.alias("x")), "whole", None)


def first_centroids(rows: DataFrame, k: int = K) -> np.ndarray:
    """The k rows with the smallest hash of their ids; k vectors reach the driver."""
    key = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    return np.array([r["x"] for r in rows.orderBy(F.asc_nulls_last(key), "x").limit(k).select("x").collect()], np.int64)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of the exact means; those without vectors stay."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((k, dim + 1), np.int64)
        for _, x in blocks(batches, "x", dim):
            number, _ = nearest(x, centroids)
            order = np.argsort(number, kind="stable")
            there, starts, n = np.unique(number[order], return_index=True, return_counts=True)
            seen[there, :dim] += np.add.reduceat(x[order], starts, axis=0)
            seen[there, dim] += n
        yield cells(seen, "value")

    got = summed(rows.select("x").mapInArrow(run, "cell long, value long")
                 .withColumn("value", F.col("value").cast("decimal(38,0)")), "value", k * (dim + 1))
    out = centroids.copy()
    for c in range(k):
        *sums, n = (int(v) for v in got[c * (dim + 1):(c + 1) * (dim + 1)])
        if n:
            out[c] = [s // n for s in sums]
    return out


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every row."""
    kind, dim = rows.schema["vec_id"].dataType.simpleString(), centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in blocks(batches, "x", dim):
            number, distance = nearest(x, centroids)
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)],
                                             names=["vec_id", "cluster", "distance"])

    return rows.select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def fit(rows: DataFrame, k: int = K, rounds: int = ROUNDS) -> np.ndarray:
    """The centroids after ``rounds`` rounds; no rows, no centroids."""
    centroids = first_centroids(rows, k)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(rows, centroids)
    return centroids


def clustered(table: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept row."""
    rows = whole_rows(table, dim=dim)
    centroids = fit(rows, k, rounds)
    if not len(centroids):
        return rows.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in (
            "distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256")).limit(0)
    found = stored(assigned(rows, centroids), "assigned", None)
    per_cluster = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of_cluster = lambda values: F.element_at(F.lit(values), F.col("cluster") + 1)
    return found.select("vec_id", "cluster", "distance",
                        of_cluster([per_cluster.get(c, 0) for c in range(len(digests))]).cast("long").alias("cluster_inertia"),
                        F.lit(sum(per_cluster.values())).cast("long").alias("inertia"), of_cluster(digests).alias("centroid_sha256"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _op12_sql() -> str:
    """The same rounds in SQL, by comparing every vector with every centroid."""
    distance = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"

    def nearest_(r: int) -> str:
        return (f"a{r} AS MATERIALIZED (SELECT id, arg_min(k, d * 64 + k) AS k, min(d) AS d FROM "
                f"(SELECT v.id, c.k, {distance} AS d FROM v, c{r} c) GROUP BY id)")

    steps = [f"""
        v AS MATERIALIZED (
            SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda e: floor({SCALE} * e::DOUBLE)::BIGINT) AS x
            FROM embeddings WHERE len(embedding) = {DIM}
              AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h, x) - 1 AS k, x
            FROM (SELECT sha256('2:' || vec_id) AS h, x FROM v ORDER BY h NULLS LAST, x LIMIT {K}))"""]
    for r in range(ROUNDS):
        steps += [nearest_(r), f"""
        m{r} AS MATERIALIZED (
            SELECT k, list(s ORDER BY i) AS x FROM (
                SELECT k, i, floor(sum(e)::DOUBLE / count(*))::BIGINT AS s
                FROM (SELECT a.k, unnest(v.x) AS e, generate_subscripts(v.x, 1) AS i FROM v JOIN a{r} a USING (id))
                GROUP BY k, i) GROUP BY k),
        c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m USING (k))"""]
    return "WITH " + ",".join([*steps, nearest_(ROUNDS)]) + f"""
        SELECT v.vec_id, a.k::INTEGER AS cluster, a.d AS distance,
               sum(a.d) OVER (PARTITION BY a.k)::BIGINT AS cluster_inertia, sum(a.d) OVER ()::BIGINT AS inertia,
               sha256(array_to_string(c.x, ',')) AS centroid_sha256
        FROM v JOIN a{ROUNDS} a USING (id) JOIN c{ROUNDS} c USING (k)"""


OP12_SQL = _op12_sql()
