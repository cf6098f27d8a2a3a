"""Centroids with screened distances against all distances."""

import hashlib

import numpy as np
import pytest

from fluvia.llm import centroids


def plain(rows, k, rounds, scale, d):
    """rows (id, vector): [(id, cluster, distance)], centroids."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == d and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), np.array(v, "<i4").tobytes(), v) for i, v in kept if i is not None)[:k]
    c = [v for _, _, v in first]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((gap(v, x), j) for j, x in enumerate(c))
    for _ in range(rounds):
        mine = [near(v)[1] for _, v in kept]
        c = [[sum(x) // len(x) for x in zip(*own)] if (own := [v for (_, v), m in zip(kept, mine) if m == j]) else old for j, old in enumerate(c)]
    return [(i, *reversed(near(v))) for i, v in kept], c


def told(table, **how):
    found, c = centroids.cluster(table, **how)
    key = lambda r: (-1 if r[0] is None else r[0], *r[1:])
    return sorted(((r.id, r.cluster, r.distance) for r in found.collect()), key=key), c


def same(spark, rows, k=7, rounds=3, scale=256, d=12, segment=5):
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, s string").repartition(3)
    found, c = told(table, k=k, rounds=rounds, scale=scale, dimensions=d, segment=segment)
    expected, plain_c = plain(rows, k, rounds, scale, d)
    assert found == sorted(expected, key=lambda r: (-1 if r[0] is None else r[0], *r[1:]))
    assert c.tolist() == plain_c


def test_all_distances(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(5, 12)) * np.array([[0.1], [1], [3], [9], [0.5]])
    v = centre[rng.integers(0, 5, 300)] + rng.normal(size=(300, 12)) * 0.3
    v[50:150] = v[50]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    rows += [(7, v[7].tolist()), (900, None), (901, [0.0] * 12), (902, [float("nan")] * 12), (903, [None] * 12), (904, [1.0] * 11), (905, [float("inf")] * 12), (906, []), (None, v[3].tolist())]
    same(spark, rows)


def test_ties_few_rows_and_coarse_integers(spark):
    rng = np.random.default_rng(8)
    same(spark, [(i, rng.integers(-1, 2, 12).astype(float).tolist()) for i in range(80)], scale=1, k=9)
    same(spark, [(i, [0.25] * 12) for i in range(3)], k=7)
    same(spark, [(i, (rng.normal(size=12) * 2.0**16).tolist()) for i in range(40)])
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert told(empty)[0] == []
    with pytest.raises(Exception, match="beyond"):
        told(spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>"))


def test_bounds_are_below_and_prune():
    rng = np.random.default_rng(1)
    v = np.floor(rng.normal(size=(500, 64)) * 256 * rng.choice([0.01, 1, 30], size=(500, 1))).astype(np.int64)
    c = v[:40]
    s = centroids.norms(v, 8)
    exact = ((v[:, None] - c[None]) ** 2).sum(2)
    assert (centroids.bounds(s, s[:40]) <= exact).all()
    cluster, distance, taken = centroids.nearest(v, s, c, s[:40])
    assert (cluster == exact.argmin(1)).all() and (distance == exact.min(1)).all()
    assert taken < exact.size * 0.7  # of three sizes of vectors, the centroids of a larger size are left out
