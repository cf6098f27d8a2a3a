"""Neighbours of the permutation index against all distances."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluvia.llm import ann


def nearest(ids, vectors, query, top=10):
    at = ids.index(query)
    gap = np.sqrt(((vectors - vectors[at]) ** 2).sum(1))
    return [(ids[i], gap[i]) for i in sorted(range(len(ids)), key=lambda i: (gap[i], ids[i])) if i != at][:top]


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(60, 8))
    v[20:45] = v[20]
    rows = [(i, x.tolist(), 1) for i, x in enumerate(v)] + [(100, None, 1), (200, [0.0] * 8, 1), (300, [float("nan")] * 8, 1), (400, [1.0, None], 1), (None, [1.0] * 8, 1), (0, v[0].tolist(), 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int").repartition(3)
    found = ann.search(table, lambda i: i % 10 == 0, part_rows=16, query_rows=3).collect()
    ids = list(range(60))
    for q in range(0, 60, 10):
        own = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == q)
        assert [r[0] for r in own] == list(range(1, 11))
        expected = nearest(ids, v, q)
        assert [r[1] for r in own] == [i for i, _ in expected]
        assert [r[2] for r in own] == pytest.approx([d for _, d in expected])
    assert {r.query_id for r in found} == set(range(0, 60, 10))
    assert ann.search(table.limit(0), lambda i: i % 10 == 0).count() == 0


def recall(found, ids, v):
    """Of each query, by distance, so that ties are no misses."""
    out, at = [], {x: i for i, x in enumerate(ids)}
    for q, own in found.groupBy("query_id").agg(F.collect_list("score").alias("own")).collect():
        gap = np.sqrt(((v - v[at[q]]) ** 2).sum(1))
        gap[at[q]] = np.inf
        out.append(np.mean(np.array(own) <= np.sort(gap)[9] * (1 + 1e-12)))
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    at = f"/root/testdata/{sf}"
    if not os.path.isdir(at):
        pytest.skip("no tables here")
    table = spark.read.parquet(f"{at}/embeddings.parquet")
    rows = table.filter("embedding is not null").collect()
    ids, v = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    hit = recall(ann.op7_permutation(spark, at), ids, v)
    assert len(hit) == sum(i % 100 == 0 for i in ids) and np.mean(hit) >= 0.9 and min(hit) >= 0.7
    assert np.mean(recall(ann.search(table, lambda i: i % 10 == 0), ids, v)) >= 0.9


def test_recall_without_clusters(spark):
    """2,000 vectors of 64 normal components: the hardest case for any index."""
    v = np.random.default_rng(4).normal(size=(2_000, 64))
    table = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "vec_id long, embedding array<double>").repartition(4)
    assert np.mean(recall(ann.search(table, lambda i: i % 20 == 0), list(range(2_000)), v)) >= 0.9


def test_few_shared_pivots():
    """Where no entry meets the query often enough, the most met ones are measured."""
    place = np.array([[0, 1, 9, 9], [9, 0, 1, 9], [9, 9, 0, 1], [9, 9, 1, 0]], np.uint8)
    files = ann._Files(place, 2)
    assert files.ranked(place[0], 2, 2, 1).tolist() == [0]
    assert sorted(files.ranked(place[0], 2, 2, 2).tolist()) == [0, 1]
    assert sorted(files.ranked(place[0], 2, 3, 9).tolist()) == [0, 1, 2, 3]


def test_recall_where_footrule_decides(spark):
    """20,000 clustered vectors in four parts: a query measures 200 of them exactly, a hundredth."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(200, 24))
    v = centres[rng.integers(0, 200, 20_000)] + 0.6 * rng.normal(size=(20_000, 24))
    table = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "vec_id long, embedding array<double>").repartition(4)
    found = ann.search(table, lambda i: i % 200 == 0, part_rows=5_000, rerank=0.01, least_rerank=10).groupBy("query_id").agg(F.collect_set("vec_id").alias("own")).collect()
    ids = list(range(20_000))
    hit = [len(set(r.own) & {i for i, _ in nearest(ids, v, r.query_id)}) / 10 for r in found]
    assert len(found) == 100 and np.mean(hit) >= 0.9


def test_ids_with_several_vectors_and_odd_lengths(spark):
    rows = [(i, [float(i), 1.0]) for i in range(1, 20)] + [(5, [100.0, 1.0]), (0, [7.4, 1.0]), (0, [50.0, 1.0]), (30, [1.0, 2.0, 3.0]), (31, [1.0, 2.0, 4.0])]
    found = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i % 10 == 0, top=3).collect()
    assert [(r.vec_id, round(r.score, 6)) for r in sorted(found, key=lambda r: r.rank) if r.query_id == 0] == [(7, 0.4), (8, 0.6), (6, 1.4)]
    assert [(r.vec_id, r.score) for r in found if r.query_id == 30] == [(31, 1.0)]
