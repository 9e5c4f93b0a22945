"""Centroid clustering with geometric drift tightening (operator 12).

Lloyd rounds on integer vectors, exact. Each vector keeps its distance to its
own centroid and one lower bound to all others. When centroids move, the bound
of a vector in cluster a is loosened by the most that any other centroid j can
have come nearer to *some point of a's sphere* (centre: a's old centroid,
radius: its farthest vector), which is a question in the plane of a's centre
and j's move:

    d(x, j) - d(x, j') = f  lies on a hyperbola with foci j and j', |j j'| = D.
    For f > 0 its branch stays inside its asymptotes, the lines from the
    midpoint at angle arccos(f / D), so f <= D cos(angle of x at the midpoint).
    The sphere spans arcsin(radius / distance) around its centre's angle.

A sphere off the line of the move loosens by less than the full drift D, one
behind the midpoint not at all. Vectors whose bound still clears their own
distance keep their cluster; all others are scanned exactly against every
centroid. Bounds are doubles with slack; what they decide is certain, and ties
are always scanned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import written

VECTORS = "vec_id long, v binary"
STATE = "vec_id long, v binary, cluster int, distance long, lower double, n_scans int"
PARTIAL = "cluster int, component int, total long, n long, far long"
#: Components beyond this would let a squared distance of 64 of them leave 63 bits.
LARGEST = 1 << 27
_SLACK = 1e-7


def _quantised(batches: Iterator[pa.RecordBatch], width: int, scale: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(1)
        rows = batch.filter(pa.array(lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == width))
        x = rows.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
        fine = np.isfinite(x).all(axis=1)  # a null component reads as NaN
        ids, x = rows.column(0).filter(pa.array(fine)), np.floor(x[fine] * scale)
        if len(x) and np.abs(x).max() > LARGEST:
            raise ValueError(f"a component times {scale} is beyond +-{LARGEST}: its squared distances do not fit a long")
        raw = np.ascontiguousarray(x.astype("<i4")).tobytes()
        packed = pa.array([raw[k : k + 4 * width] for k in range(0, len(raw), 4 * width)], pa.binary())
        yield pa.RecordBatch.from_arrays([ids, packed], names=["vec_id", "v"])


def quantised(vectors: DataFrame, width: int = 64, scale: int = 64) -> DataFrame:
    """(vec_id, v): vectors of exactly ``width`` finite components as
    floor(scale * x) in little-endian 32-bit integers, as a table."""
    rows = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("embedding")
    )
    return written(rows.mapInArrow(lambda it: _quantised(it, width, scale), VECTORS), "vectors")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i4").reshape(-1, width).astype(np.int64)


def scan(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest centroid, its squared distance, that of the second nearest) by
    exact integer arithmetic; ties go to the smaller number."""
    best = np.full(len(x), np.iinfo(np.int64).max)
    second, where = best.copy(), np.zeros(len(x), dtype=np.int32)
    for j, c in enumerate(centroids):
        d = ((x - c) ** 2).sum(axis=1)
        nearer = d < best
        second = np.where(nearer, best, np.minimum(second, d))
        best, where = np.where(nearer, d, best), np.where(nearer, np.int32(j), where)
    return where, best, second


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster, the most that any other centroid's move from ``old`` to
    ``new`` can shorten its distance to a point of the cluster's sphere."""
    old, new = old.astype(np.float64), new.astype(np.float64)
    move = new - old
    drift = np.sqrt((move**2).sum(axis=1))
    away = old[:, None, :] - (old + new)[None, :, :] / 2  # [a, j]: from the midpoint of j's move to a's centre
    dist = np.sqrt((away**2).sum(axis=2))
    r = radius[:, None] * (1 + _SLACK) + _SLACK
    with np.errstate(divide="ignore", invalid="ignore"):
        angle = np.arccos(np.clip((away * move[None]).sum(axis=2) / (dist * drift[None]), -1, 1))
        spread = np.arcsin(np.clip(r / dist, 0, 1))
        some = drift[None] * np.maximum(0, np.cos(np.maximum(0, angle - spread)))
    most = np.where(drift[None] == 0, 0, np.where(r >= dist, drift[None], some))
    np.fill_diagonal(most, 0)
    return most.max(axis=1)


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, loose: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    k, width = centroids.shape
    for batch in batches:
        x = _matrix(batch.column(1), width)
        if loose is None:
            cluster, scans = np.zeros(len(x), dtype=np.int32), np.zeros(len(x), dtype=np.int32)
            distance, lower = np.zeros(len(x), dtype=np.int64), np.full(len(x), -np.inf)
        else:
            cluster, lower, scans = (batch.column(c).to_numpy(zero_copy_only=False).copy() for c in (2, 4, 5))
            distance = ((x - centroids[cluster]) ** 2).sum(axis=1)
            lower -= loose[cluster]
        lower -= _SLACK * (1 + np.abs(np.where(np.isfinite(lower), lower, 0)))
        own = np.sqrt(distance.astype(np.float64))
        unsure = np.flatnonzero(own * (1 + _SLACK) + _SLACK >= lower)
        where, best, second = scan(x[unsure], centroids)
        cluster[unsure], distance[unsure] = where, best
        lower[unsure] = np.sqrt(second.astype(np.float64)) if k > 1 else np.inf
        scans[unsure] += 1
        columns = [batch.column(0), batch.column(1), *map(pa.array, (cluster, distance, lower, scans))]
        yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "cluster", "distance", "lower", "n_scans"])


def _partial(batches: Iterator[pa.RecordBatch], k: int, width: int) -> Iterator[pa.RecordBatch]:
    total, n, far = np.zeros((k, width), np.int64), np.zeros(k, np.int64), np.zeros(k, np.int64)
    for batch in batches:
        cluster = batch.column(1).to_numpy(zero_copy_only=False)
        np.add.at(total, cluster, _matrix(batch.column(0), width))
        n += np.bincount(cluster, minlength=k)
        np.maximum.at(far, cluster, batch.column(2).to_numpy(zero_copy_only=False))
    held = np.flatnonzero(n)
    rows = [np.repeat(held, width), np.tile(np.arange(width), len(held)), total[held].ravel(), np.repeat(n[held], width), np.repeat(far[held], width)]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, kinds, strict=True)], names=["cluster", "component", "total", "n", "far"])


def moved(state: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(new centroids, radius of each cluster's sphere about its old centroid):
    k * width rows of sums come back, whatever the size of the table."""
    k, width = centroids.shape
    partial = state.select("v", "cluster", "distance").mapInArrow(lambda it: _partial(it, k, width), PARTIAL)
    sums = partial.groupBy("cluster", "component").agg(F.sum("total").alias("total"), F.sum("n").alias("n"), F.max("far").alias("far"))
    new, radius = centroids.copy(), np.zeros(k)
    for r in sums.collect():
        new[r["cluster"], r["component"]] = r["total"] // r["n"]
        radius[r["cluster"]] = np.sqrt(float(r["far"]))
    return new, radius


def first_centroids(vectors: DataFrame, k: int, width: int, seed: str) -> np.ndarray:
    """The k vectors with smallest sha256 of seed and id, ties by their bytes;
    rows without an id come last."""
    code = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(code.alias("code"), "v").orderBy(F.col("code").asc_nulls_last(), "v").limit(k).collect()
    return np.array([np.frombuffer(r["v"], dtype="<i4") for r in rows], dtype=np.int64).reshape(-1, width)


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, width: int = 64, scale: int = 64, seed: str = "1") -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared, to its final
    centroid), cluster_inertia, inertia, centroid_sha256, and n_scans (how many
    of the rounds + 1 assignments had to scan all centroids).

    Vectors that are null, of another length, or with a null or non-finite
    component are left out. Repeated rows are vectors of their own; rows without
    vec_id are clustered like the others but start no centroid while others can.
    Fewer than k vectors start fewer centroids; equal centroids leave the later
    one empty, and empty ones stay. Ties go to the smaller number. No kept
    vector: no rows. A component whose square could overflow is an error.
    Columns besides vec_id and embedding are left behind.
    """
    spark, kept = vectors.sparkSession, quantised(vectors, width, scale)
    centroids = first_centroids(kept, k, width, seed)
    if not len(centroids):
        schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, n_scans int"
        return spark.createDataFrame([], schema)

    def assigned(rows: DataFrame, at: np.ndarray, loose: np.ndarray | None, turn: int) -> DataFrame:
        return written(rows.mapInArrow(lambda it: _assigned(it, at, loose), STATE), f"clusters-{turn}")

    state = assigned(kept, centroids, None, 0)
    for turn in range(rounds):
        new, radius = moved(state, centroids)
        state = assigned(state, new, loosening(centroids, new, radius), turn + 1)
        centroids = new
    sums = {r["cluster"]: r["n"] for r in state.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}  # k rows
    codes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = [(j, sums.get(j, 0), sum(sums.values()), code) for j, code in enumerate(codes)]
    named = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_scans"
    )
