"""Operator 12 against plain Python Lloyd rounds, its bounds, and its SQL."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marquee.llm import centroids, queries
from tests.oracle_check import compare

SCHEMA = "vec_id long, embedding array<float>"


def vectors(sf="sf0.001", n=None):
    t = pq.read_table(f"/root/testdata/{sf}/embeddings.parquet")
    return list(zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist(), strict=True))[:n]


def brute(rows, k=16, rounds=3, width=64):
    kept = []
    for vec_id, e in rows:
        if e is not None and len(e) == width and all(x is not None and math.isfinite(x) for x in e):
            kept.append((vec_id, [math.floor(64 * float(np.float32(x))) for x in e]))
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes()))
    cents = [list(v) for _, v in first[:k]]
    for turn in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cents)) for _, v in kept]
        if turn < rounds:
            for j in range(len(cents)):
                mine = [v for (_, v), (_, m) in zip(kept, near, strict=True) if m == j]
                if mine:
                    cents[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    every = sum(d for d, _ in near)
    return [
        (v, j, d, sum(x for x, m in near if m == j), every, hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest())
        for (v, _), (d, j) in zip(kept, near, strict=True)
    ]


def order(rows):
    return sorted((tuple(r)[:6] for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def run(spark, rows, schema=SCHEMA, **more):
    return centroids.cluster(spark.createDataFrame(rows, schema), **more).collect()


def test_brute_force(spark):
    rows = vectors()
    assert order(run(spark, rows)) == order(brute(rows))


def test_edges(spark):
    ok = vectors(n=40)
    bad = [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65), (904, [float("nan")] + [0.0] * 63), (905, [None] + [0.0] * 63), (906, [float("inf")] + [0.0] * 63)]
    more = [ok[3], ok[3], (ok[4][0], ok[5][1]), (None, ok[6][1]), (None, ok[7][1]), (950, [0.0] * 64), (951, [0.0] * 64)]
    rows = ok + bad + more
    assert order(run(spark, rows)) == order(brute(rows))
    assert run(spark, bad) == [] and run(spark, []) == []
    assert order(run(spark, ok[:5] + [ok[0]])) == order(brute(ok[:5] + [ok[0]]))
    wide = [(v, e, 1, "x", 2.0) for v, e in ok]
    assert order(run(spark, wide, SCHEMA + ", cluster int, v string, distance double")) == order(brute(ok))


def test_equal_vectors_leave_centroids_empty(spark):
    rows = [(k, [0.5] * 64) for k in range(30)] + [(100 + k, [1.0 + k] * 64) for k in range(3)]
    assert order(run(spark, rows)) == order(brute(rows))


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="do not fit a long"):
        run(spark, [(1, [1e30] * 64)])


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(2, 6), st.integers(1, 8))
def test_loosening_bounds_every_point_of_the_sphere(seed, k, width):
    r = np.random.default_rng(seed)
    old = r.integers(-40, 40, (k, width))
    new = old + r.integers(-12, 12, (k, width)) * r.integers(0, 2, (k, 1))
    radius = r.uniform(0, 40, k)
    loose = centroids.loosening(old, new, radius)
    drift = np.sqrt(((new - old) ** 2).sum(axis=1))
    for a in range(k):
        others = [j for j in range(k) if j != a]
        assert loose[a] <= drift[others].max() + 1e-9
        ray = r.normal(size=(200, width))
        ray *= (radius[a] * r.uniform(0, 1, (200, 1)) ** 0.2) / np.linalg.norm(ray, axis=1, keepdims=True)
        x = old[a] + ray
        for j in others:
            nearer = np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)
            assert nearer.max() <= loose[a] + 1e-6


def test_spheres_behind_the_move_are_not_loosened():
    old, new = np.array([[0, 0], [100, 0]]), np.array([[0, 0], [110, 0]])
    assert centroids.loosening(old, new, np.array([5.0, 5.0]))[0] == 0
    new = np.array([[0, 0], [90, 30]])
    assert 0 < centroids.loosening(old, new, np.array([5.0, 5.0]))[0] < 30


def test_tightening_spares_scans(spark, monkeypatch):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(16, 64)) * 3
    rows = [(k, (middles[k % 16] + rng.normal(size=64) * 0.1).astype(np.float32).tolist()) for k in range(600)]
    got = run(spark, rows)
    assert order(got) == order(brute(rows))
    tight = sum(r["n_scans"] for r in got)

    def full(old, new, radius):
        d = np.sqrt(((new - old).astype(float) ** 2).sum(axis=1))
        return np.array([max(np.delete(d, a)) for a in range(len(d))])

    monkeypatch.setattr(centroids, "loosening", full)
    plain = run(spark, rows)
    assert order(plain) == order(got)
    assert tight <= sum(r["n_scans"] for r in plain) < 4 * 600


def test_query_equals_sql(spark):
    got = compare(spark, "op12_centroids", queries.op12_centroids, queries.ORACLE_SQL["op12_centroids"], "/root/testdata/sf0.01")
    assert "error" not in got and got["spark_rows"] == 500
