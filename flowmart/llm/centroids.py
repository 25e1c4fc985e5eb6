"""Centroid clustering of integer vectors by Shallot search (operator 11).

Every vector carries the numbers of its nearest and second-nearest centroid, an upper bound of its
distance to the first and a lower bound of its distance to all others.  After the centroids have
moved the bounds are widened by the moves.  A vector whose upper bound is below its lower bound, or
below half the distance from its centroid to the next one, keeps its centroid without a look at any
other.  For the rest the distances to the two remembered centroids are worked out and the search
starts from the closer one: its neighbours are tried in order of their distance from it, inside a
ball of radius (distance to the start + distance to the second nearest so far), which shrinks as
nearer ones turn up.  Distances are compared as integers, so ties are exact (the smaller number
wins); bounds are floating point with a margin, so rounding never hides a centroid.

The vectors with their bounds are a table that each pass reads and writes anew, without a shuffle;
each pass also sums its clusters per batch, and one row per cluster reaches the driver.  What the
driver holds is set by the number of centroids and components alone.

Defined cases: rows whose vector has another length, a null or a non-finite component are left out;
a null id never starts a centroid while others are left; repeated ids and rows count separately;
with fewer vectors than centroids every vector starts one; an empty table gives an empty result.
Components beyond 2^27 in absolute value are refused with an error: their squared distances would
not fit the long that the result holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmart.llm import common as C

SIZE = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
#: components up to this keep 64 squared differences within a long
MOST = 1 << 27
#: relative margin of the bounds: pruning needs more than rounding could explain
MARGIN = 1e-9

_STATE = "vec_id bigint, v array<int>, near int, second int, upper double, lower double"


def integers(vector: str | Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, as a long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def kept(vectors: DataFrame, vec_id: str, vector: str, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """vec_id, v (integers) of the rows whose vector has ``size`` finite components."""
    x = F.col(vector)
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
    whole = vectors.where((F.size(x) == size) & fine).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), integers(x, scale).alias("v"))
    small = F.forall("v", lambda e: F.abs(e) <= MOST)
    return whole.select("vec_id", F.when(small, F.col("v")).otherwise(F.raise_error(
        F.lit("a component is too large for squared distances in a long"))).cast("array<int>").alias("v"))


def first_centroids(rows: DataFrame, k: int = CENTROIDS) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of their id, in that order."""
    digest = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    top = rows.select(digest.alias("d"), "v").orderBy(F.col("d").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in top], dtype=np.int64)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = v - c
    return np.einsum("ij,ij->i", d, d)


def search(v: np.ndarray, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray,
           centroids: np.ndarray) -> int:
    """Shallot search: updates ``near``, ``second``, ``upper`` and ``lower`` in place.  Returns how
    many distances it worked out."""
    k = len(centroids)
    if k == 1:
        upper[:] = np.sqrt(squared(v, centroids[near]))
        return len(v)
    apart = np.sqrt(((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2).astype(np.float64))
    order = np.argsort(apart, axis=1, kind="stable")
    # a centroid is its own first neighbour, also where another one lies on the same spot
    order = np.array([[c, *(j for j in row if j != c)] for c, row in enumerate(order)])
    half = apart[np.arange(k), order[:, 1]] / 2
    rows = np.flatnonzero(upper * (1 + MARGIN) >= np.maximum(lower, half[near]))
    if not len(rows):
        return 0
    x, a, b = v[rows], near[rows].astype(np.int64), second[rows].astype(np.int64)
    da, db = squared(x, centroids[a]), squared(x, centroids[b])
    done = 2 * len(rows)
    swap = (db < da) | ((db == da) & (b < a))
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    da, db = np.where(swap, db, da), np.where(swap, da, db)
    start, reach = a.copy(), np.sqrt(da.astype(np.float64))
    one, two = a.copy(), b.copy()  # the remembered ones are known already
    live = np.arange(len(rows))
    for step in range(1, k):
        j = order[start[live], step]
        ball = (reach[live] + np.sqrt(db[live].astype(np.float64))) * (1 + MARGIN)
        inside = apart[start[live], j] <= ball
        live, j = live[inside], j[inside]  # neighbours further out lie outside the ball as well
        if not len(live):
            break
        new = (j != one[live]) & (j != two[live])
        at, c = live[new], j[new]
        d = squared(x[at], centroids[c])
        done += len(at)
        first = (d < da[at]) | ((d == da[at]) & (c < a[at]))
        after = ~first & ((d < db[at]) | ((d == db[at]) & (c < b[at])))
        p = at[first]
        db[p], b[p] = da[p], a[p]
        da[p], a[p] = d[first], c[first]
        p = at[after]
        db[p], b[p] = d[after], c[after]
    near[rows], second[rows] = a, b
    upper[rows], lower[rows] = np.sqrt(da.astype(np.float64)), np.sqrt(db.astype(np.float64))
    return done


def _vectors(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def _assign(centroids: np.ndarray, moved: np.ndarray | None):
    """One pass: widen the bounds by the centroids' moves, search, hand the rows on."""
    size = centroids.shape[1]
    if moved is not None and len(moved) > 1:
        top = np.argsort(-moved, kind="stable")[:2]
        others = np.where(np.arange(len(moved)) == top[0], moved[top[1]], moved[top[0]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _vectors(batch, size)
            near, second = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int32)
                            for c in ("near", "second"))
            upper, lower = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64)
                            for c in ("upper", "lower"))
            if moved is not None:
                upper = (upper + moved[near]) * (1 + MARGIN)
                if len(moved) > 1:
                    lower = np.maximum((lower - others[near]) * (1 - MARGIN), 0.0)
            search(v, near, second, upper, lower, centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(near), pa.array(second),
                 pa.array(upper), pa.array(lower)],
                names=["vec_id", "v", "near", "second", "upper", "lower"])
    return run


def _sums(size: int):
    """Per batch and cluster: how many vectors, and their sum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, near = _vectors(batch, size), batch.column("near").to_numpy(zero_copy_only=False)
            found, place, n = np.unique(near, return_inverse=True, return_counts=True)
            total = np.zeros((len(found), size), dtype=np.int64)
            np.add.at(total, place, v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int32()), pa.array(n, pa.int64()),
                 C.lists(total.ravel(), np.arange(len(found) + 1) * size, pa.int64())], names=["near", "n", "total"])
    return run


def moved_centroids(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid with vectors moves to the exact floor of their mean; others stay."""
    size = centroids.shape[1]
    sums = state.select("v", "near").mapInArrow(_sums(size), "near int, n bigint, total array<bigint>")
    per = (sums.groupBy("near").agg(F.sum("n").alias("n"), F.array(*(
        F.sum(F.col("total")[i]) for i in range(size))).alias("total")).collect())
    new = centroids.copy()
    for r in per:
        new[r["near"]] = [t // r["n"] for t in r["total"]]
    return new


def _distances(centroids: np.ndarray):
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = batch.column("near").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(near, pa.int32()),
                 pa.array(squared(_vectors(batch, size), centroids[near]), pa.int64())],
                names=["vec_id", "cluster", "distance"])
    return run


def cluster(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS,
            rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance of every kept vector; the final centroids)."""
    rows = C.written(kept(vectors, vec_id, vector, size, scale), "op11-vectors")
    centroids = first_centroids(rows, k)
    if not len(centroids):
        none = rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        return none, np.zeros((0, size), dtype=np.int64)
    state = rows.select("*", F.lit(0).alias("near"), F.lit(min(1, len(centroids) - 1)).alias("second"),
                        F.lit(float("inf")).alias("upper"), F.lit(0.0).alias("lower"))
    moved, old = None, [rows]
    for _ in range(rounds):
        state = C.written(state.mapInArrow(_assign(centroids, moved), _STATE), "op11-state")
        new = moved_centroids(state, centroids)
        moved = np.sqrt(((new - centroids) ** 2).sum(axis=1).astype(np.float64)) * (1 + MARGIN)
        centroids = new
        C.drop(old.pop())
        old.append(state)
    last = state.mapInArrow(_assign(centroids, moved), _STATE)
    found = C.written(last.mapInArrow(_distances(centroids), "vec_id bigint, cluster int, distance bigint"),
                      "op11-clusters")
    C.drop(state if rounds else rows)
    return found, centroids


def digest(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """One row per vector with the inertias and the checksum of its centroid."""
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    per = found.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()
    sums = {r["cluster"]: r["n"] for r in per}
    inertia = [sums.get(c, 0) for c in range(len(centroids))]
    at = F.col("cluster") + 1
    return found.select(
        "vec_id", "cluster", "distance",
        F.element_at(F.array(*(F.lit(n).cast("bigint") for n in inertia or [0])), at).alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("bigint").alias("inertia"),
        F.element_at(F.array(*map(F.lit, marks or [""])), at).alias("centroid_sha256"))
