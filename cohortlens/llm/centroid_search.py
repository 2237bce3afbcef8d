"""Centroid clustering by equal-average, equal-variance search.

Vectors are integers, so every sum and distance is exact. The centroids are
sorted by the mean of their components; a vector starts at its own mean and
scans outward, the nearer mean of both sides first. With ``d`` components,
sums ``S`` and deviations ``V = |x - mean(x)|``

    |x - c|^2  >=  (Sx - Sc)^2 / d                     (mean inequality)
    |x - c|^2  >=  (Sx - Sc)^2 / d + (Vx - Vc)^2       (and deviation)

so the scan ends when the first exceeds the best distance so far, as every
centroid further out exceeds it too, and a centroid that fails the second is
passed over. Only what is left gets its exact integer distance. Bounds are
floating point and lowered by their rounding error, so none rejects a nearest
centroid; ties go to the smaller number.

A round is one pass: tasks hold the centroids (``clusters`` x ``dims``
numbers) and return exact sums for each cluster, which Spark adds up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import written

#: Largest component for which a squared distance fits 64 bits (64 of them).
MOST = 1 << 27
#: Relative rounding error allowed for in the bounds.
_ROUNDING = 1e-12


def integer_vectors(table: DataFrame, dims: int = 64, scale: int = 64) -> DataFrame:
    """``vec_id, v``: the vectors with exactly ``dims`` components, none of
    them null or not finite, as integers ``floor(scale * x)``."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    whole = lambda x: F.floor(x.cast("double") * scale).cast("bigint")
    return (table.select("vec_id", "embedding").filter((F.size("embedding") == dims) & ~F.exists("embedding", bad))
            .select("vec_id", F.transform("embedding", whole).alias("v")))


def deviation2(X: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Squared distance of each row to its mean; taken around a rounded
    mean, so that nothing cancels."""
    d = X.shape[1]
    near = X - np.floor_divide(2 * sums + d, 2 * d)[:, None]
    return np.einsum("ij,ij->i", near, near).astype(np.float64) - near.sum(axis=1).astype(np.float64) ** 2 / d


def nearest(X: np.ndarray, C: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest row of ``C`` and the squared distance, for each
    row of ``X``, and how many exact distances that took."""
    (n, d), k = X.shape, len(C)
    sums = C.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    C, s = C[order], sums[order]
    dev2 = deviation2(C, s)
    dev = np.sqrt(dev2)
    xs = X.sum(axis=1)
    xdev2 = deviation2(X, xs)
    xdev = np.sqrt(xdev2)
    hi = np.searchsorted(s, xs)
    lo = hi - 1
    best = np.full(n, np.iinfo(np.int64).max)
    number = np.full(n, k, dtype=np.int64)
    rows, finished = np.arange(n), 0
    while rows.size:
        low, high, x = lo[rows], hi[rows], xs[rows]
        below = np.where(low >= 0, (x - s[np.maximum(low, 0)]).astype(np.float64), np.inf)
        above = np.where(high < k, (s[np.minimum(high, k - 1)] - x).astype(np.float64), np.inf)
        left, gap = below <= above, np.minimum(below, above)
        bound = gap * gap / d
        stay = bound * (1 - _ROUNDING) <= best[rows]
        rows, left, bound = rows[stay], left[stay], bound[stay]
        at = np.where(left, low[stay], high[stay])
        lo[rows[left]] -= 1
        hi[rows[~left]] += 1
        bound = bound + (xdev[rows] - dev[at]) ** 2
        ok = bound - _ROUNDING * (bound + xdev2[rows] + dev2[at]) <= best[rows]
        near, at = rows[ok], at[ok]
        apart = X[near] - C[at]
        dist, which = np.einsum("ij,ij->i", apart, apart), order[at]
        better = (dist < best[near]) | ((dist == best[near]) & (which < number[near]))
        best[near[better]], number[near[better]] = dist[better], which[better]
        finished += near.size
    return number, best, finished


def _batches(it: Iterator[pa.RecordBatch], dims: int):
    for batch in it:
        if not batch.num_rows:
            continue
        X = batch.column("v").flatten().to_numpy().reshape(-1, dims)
        if np.abs(X).max(initial=0) > MOST:
            raise ValueError(f"a scaled component exceeds {MOST}: squared distances would not fit 64 bits")
        yield batch, X


def _moved(vectors: DataFrame, C: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floors of the means of their
    vectors; a centroid without any stays."""
    k, dims = C.shape

    def sums(it):
        total = np.zeros((k, dims + 1), dtype=np.int64)
        for _, X in _batches(it, dims):
            number, _, _ = nearest(X, C)
            by = np.argsort(number, kind="stable")
            first = np.flatnonzero(np.diff(number[by], prepend=-1))
            total[number[by][first], :dims] += np.add.reduceat(X[by], first)
            total[:, dims] += np.bincount(number, minlength=k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(k, dtype=np.int32), dims + 1)),
             pa.array(np.tile(np.arange(dims + 1, dtype=np.int32), k)), pa.array(total.ravel())],
            names=["cluster", "at", "total"])

    added = (vectors.select("v").mapInArrow(sums, "cluster int, at int, total long")
             .groupBy("cluster", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
    total = {(r["cluster"], r["at"]): int(r["total"]) for r in added}  # clusters * (dims + 1) numbers
    return np.array([[total[c, j] // total[c, dims] for j in range(dims)] if total.get((c, dims)) else C[c]
                     for c in range(k)], dtype=np.int64)


def assign(vectors: DataFrame, C: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` for every vector."""
    dims = C.shape[1]

    def place(it):
        for batch, X in _batches(it, dims):
            number, best, _ = nearest(X, C)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(best)],
                                             names=["vec_id", "cluster", "distance"])

    id_type = dict(vectors.dtypes)["vec_id"]
    return vectors.select("vec_id", "v").mapInArrow(place, f"vec_id {id_type}, cluster int, distance long")


def cluster(table: DataFrame, clusters: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64) -> DataFrame:
    """Cluster the vectors of ``vec_id, embedding`` and return for each kept
    one its cluster, squared distance, the summed distances of its cluster
    and of all, and the hash of its final centroid.

    Centroids start as the vectors with the smallest sha256 of
    ``1:<vec_id>``; vectors with equal ids in the order of their components.
    Rows with a null id are clustered but start no centroid. Vectors of
    another length, null, or with a null or non-finite component are left
    out; repeated rows count and return as often as they stand. With fewer
    vectors with an id than ``clusters``, each starts one; with none, or an
    empty table, the result is empty. Other columns are ignored. A scaled
    component beyond 2^27 is an error, as distances would leave 64 bits."""
    spark = table.sparkSession
    vectors = written(integer_vectors(table, dims, scale), "integer-vectors")
    mark = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = vectors.filter("vec_id is not null").orderBy(mark, "v").limit(clusters).select("v").collect()
    types = f"vec_id {dict(table.dtypes)['vec_id']}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], types)
    C = np.array([r["v"] for r in first], dtype=np.int64)
    for _ in range(rounds):
        C = _moved(vectors, C)
    placed = written(assign(vectors, C), "assigned")
    inertia = {r["cluster"]: int(r["total"]) for r in placed.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}  # one row a cluster
    rows = [(c, inertia.get(c, 0), sum(inertia.values()),
             hashlib.sha256(",".join(map(str, C[c].tolist())).encode()).hexdigest()) for c in range(len(C))]
    stats = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(stats), "cluster").select(  # one row a cluster
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
