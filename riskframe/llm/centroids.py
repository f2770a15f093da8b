"""Centroid clustering: k-means on integer vectors, assigned by the threshold algorithm.

A vector is kept if it has exactly ``dims`` components, none null, NaN or infinite; component
x becomes the integer ``floor(scale * x)``.  The first centroids are the ``k`` kept vectors of
smallest hex SHA-256 of ``<seed>:<id>``.  A round assigns every vector to its nearest centroid
(squared Euclidean distance, ties: smaller number) and replaces every centroid that has
vectors by the componentwise ``floor(sum / count)``.  A last assignment gives the result.

Assignment by the threshold algorithm: for every dimension the centroids are kept sorted by
that component.  A vector walks each list outward from its own value, one centroid a step and
dimension.  A centroid that is met for the first time is measured exactly.  The squared gaps
at the frontier sum up to a bound on what any centroid not yet met can have, so a vector stops
when that sum strictly exceeds its best distance (an equal one may still tie with a smaller
number) or when it has met all.

Only ``k`` centroids (k x dims integers) are on the driver.  A task adds its vectors up to one
row a centroid before anything is exchanged, so a centroid that holds most rows costs no more
than another.  Every round reads the vectors anew; lost executors cost their tasks only.

Cases: null, shorter, longer or non-finite vectors are not in the result; vectors without an
id come last among the candidates for a first centroid, and ties of the hash (repeated ids)
are settled by the components; repeated rows are vectors of their own; with fewer than ``k``
kept vectors each is a first centroid; an empty table gives an empty result.  Input columns
named like a result column are replaced by it, all others but the vector pass through.  A
component beyond +-2**27 after scaling has no distance that fits a long: that is an error.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import without

DIMS, CENTROIDS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1
RESULTS = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
#: Largest component, so that a squared distance of 64 dimensions fits a long.
LIMIT = 1 << 27
#: Vectors that one numpy step works on.
STEP = 1024
_FAR = np.int64(1) << np.int64(30)          # beyond any gap of components within LIMIT
_NONE = np.iinfo(np.int64).max


def whole_vectors(col: pa.Array, dims: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(mask of the kept rows, their integer components)."""
    keep = pc.equal(pc.fill_null(pc.list_value_length(col), -1), dims).to_numpy(zero_copy_only=False)
    flat = pc.cast(col.filter(pa.array(keep)).flatten(), pa.float64())
    x = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dims)
    fine = np.isfinite(x).all(1)
    keep = keep.copy()
    keep[keep] = fine
    with np.errstate(over="ignore"):
        x = np.floor(x[fine] * scale)
    if (np.abs(x) > LIMIT).any():
        raise ValueError(f"a component beyond {LIMIT} has no distance that fits a long")
    return keep, x.astype(np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, squared distance) of every vector, and the distances measured."""
    n, dims = x.shape
    k = len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable")
    value = np.take_along_axis(centroids, order, 0)
    dim = np.arange(dims)
    hi = np.stack([np.searchsorted(value[:, j], x[:, j]) for j in dim], 1) if n else np.zeros((0, dims), np.int64)
    lo = hi - 1
    best, who = np.full(n, _NONE), np.zeros(n, np.int64)
    seen, at, measured = np.zeros((n, k), bool), np.arange(n), 0
    while len(at):
        xa, down, up = x[at], lo[at], hi[at]
        gap_down = np.where(down >= 0, xa - value[np.maximum(down, 0), dim], _FAR)
        gap_up = np.where(up < k, value[np.minimum(up, k - 1), dim] - xa, _FAR)
        left = gap_down <= gap_up
        met = np.zeros((len(at), k), bool)
        met[np.arange(len(at))[:, None], order[np.where(left, down, up), dim]] = True
        row, c = np.nonzero(met & ~seen[at])
        seen[at] |= met
        exact = np.full((len(at), k), _NONE)
        exact[row, c] = ((xa[row] - centroids[c]) ** 2).sum(1)
        measured += len(row)
        first = exact.argmin(1)                                       # ties: the smaller number
        least = exact[np.arange(len(at)), first]
        better = (least < best[at]) | ((least == best[at]) & (first < who[at]))
        best[at] = np.where(better, least, best[at])
        who[at] = np.where(better, first, who[at])
        frontier = (np.where(left, gap_down, gap_up) ** 2).sum(1)
        lo[at] -= left
        hi[at] += ~left
        at = at[~((frontier > best[at]) | seen[at].all(1))]
    return who, best, measured


def _assigned(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    got = [nearest(x[a:a + STEP], centroids)[:2] for a in range(0, len(x), STEP)]
    return (np.concatenate([w for w, _ in got]), np.concatenate([d for _, d in got])) if got else \
        (np.zeros(0, np.int64), np.zeros(0, np.int64))


def first_centroids(vectors: DataFrame, id_col: str, vec_col: str, dims: int = DIMS, k: int = CENTROIDS,
                    scale: float = SCALE, seed: int = SEED) -> np.ndarray:
    """The kept vectors of smallest hash, in that order (at most ``k``)."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, x = whole_vectors(b.column(1), dims, scale)
            rows = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * dims, pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(keep)), rows], names=["h", "v"])

    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256).alias("h")
    rows = vectors.select(name, vec_col).mapInArrow(whole, "h string, v array<long>")
    top = rows.orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in top], np.int64).reshape(-1, dims)


def _totals(vectors: DataFrame, vec_col: str, centroids: np.ndarray, dims: int, scale: float) -> DataFrame:
    """(cluster, n, far, sums) of every task: its vectors, their distances and components added up."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        count, far, sums = np.zeros(k, np.int64), [0] * k, np.zeros((k, dims), np.int64)
        for b in batches:
            _, x = whole_vectors(b.column(0), dims, scale)
            who, dist = _assigned(x, centroids)
            for c in np.unique(who).tolist():
                mine = who == c
                count[c] += int(mine.sum())
                far[c] += sum(dist[mine].tolist())
                sums[c] += x[mine].sum(0)
        some = np.flatnonzero(count).tolist()
        if some:
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array(count[some]), pa.array([Decimal(far[c]) for c in some], pa.decimal128(38, 0)),
                 pa.array([sums[c] for c in some], pa.list_(pa.int64()))], names=["cluster", "n", "far", "sums"])
    return vectors.select(vec_col).mapInArrow(add, "cluster int, n long, far decimal(38,0), sums array<long>")


def moved(vectors: DataFrame, vec_col: str, centroids: np.ndarray, dims: int = DIMS, scale: float = SCALE) -> np.ndarray:
    """The centroids after one round."""
    parts = _totals(vectors, vec_col, centroids, dims, scale).select("cluster", "n", F.posexplode("sums").alias("dim", "part"))
    rows = parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    out = centroids.copy()                                            # rows: at most k x dims
    for r in rows:
        out[r["cluster"], r["dim"]] = int(r["total"]) // r["n"]
    return out


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = DIMS, k: int = CENTROIDS,
            rounds: int = ROUNDS, scale: float = SCALE, seed: int = SEED) -> DataFrame:
    """Every kept vector's row without the vector, with cluster, distance (squared),
    cluster_inertia, inertia (distances of its cluster, of all) and centroid_sha256."""
    rows = without(vectors, *RESULTS)
    centroids = first_centroids(rows, id_col, vec_col, dims, k, scale, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(rows, vec_col, centroids, dims, scale)
    inertia = {r["cluster"]: int(r["far"]) for r in _totals(rows, vec_col, centroids, dims, scale).groupBy("cluster").agg(
        F.sum("far").alias("far")).collect()} if len(centroids) else {}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    passed = [c for c in rows.columns if c != vec_col]
    schema = rows.select(*passed, F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in RESULTS[1:4]],
                         F.lit("").alias("centroid_sha256")).schema

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, x = whole_vectors(b.column(len(passed)), dims, scale)
            if not len(x):
                continue
            who, dist = _assigned(x, centroids)
            kept = b.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns[:len(passed)], pa.array(who.astype(np.int32)), pa.array(dist),
                 pa.array([inertia[c] for c in who.tolist()], pa.int64()), pa.array([sum(inertia.values())] * len(who), pa.int64()),
                 pa.array([names[c] for c in who.tolist()])], names=[*passed, *RESULTS])
    return rows.select(*passed, vec_col).mapInArrow(assign, schema)
