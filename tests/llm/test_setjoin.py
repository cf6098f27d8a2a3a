"""The set join against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fluvia.llm import setjoin, simhash


def _similar(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def _near_copies(rng, vocabulary, bases, copies):
    """Texts with so many changes that similarities lie about 0.8."""
    texts = []
    for n in bases:
        base = rng.choices(vocabulary, k=n)
        for _ in range(copies):
            t = list(base)
            for _ in range(rng.randint(0, max(1, n // 35))):
                t[rng.randrange(n)] = rng.choice(vocabulary)
            texts.append(" ".join(t))
    return texts


@pytest.mark.parametrize("max_bucket", [8192, 3])
@pytest.mark.parametrize("flush", [1 << 18, 5])
def test_no_similar_pair_is_lost(spark, max_bucket, flush, monkeypatch):
    monkeypatch.setattr(setjoin, "FLUSH", flush)
    rng = random.Random(3)
    texts = _near_copies(rng, [f"v{i}" for i in range(3000)], (3, 5, 12, 60, 150, 400), 25)
    texts += [t + " and all that every one of them says in the same words at the very end of it" for t in texts[::3]] + ["", "a"]
    sets = [np.unique(simhash.shingle_hashes(t, 5)) for t in texts]
    frequent, count = np.unique(np.concatenate(sets), return_counts=True)
    frequent, count = frequent[count > 20], count[count > 20]
    ranks = np.argsort(np.argsort(count, kind="stable"))
    rows = [(i, len(h), setjoin.prefix(h, frequent, ranks, (4, 5)).view(np.int64).tolist(), i % 40, setjoin.parities(h).tolist()) for i, h in enumerate(sets)]
    table = spark.createDataFrame(rows, "node long, n long, prefix array<long>, c long, parity array<long>").repartition(3)
    met = setjoin.meeting(table, (4, 5), max_bucket)
    found = {(r.a, r.b) for r in setjoin.maybe_similar(met, table, (4, 5)).collect()}
    whole = [set(h.tolist()) for h in sets]
    for b in range(len(sets) - 2):
        for a in range(b):
            if a % 40 != b % 40 and _similar(whole[a], whole[b]):
                assert (a, b) in found
    assert all(a < b and a % 40 != b % 40 for a, b in found)
    assert len(found) < met.count() or max_bucket == 3


def test_parities_bound_the_difference(spark):
    rng, rows = np.random.default_rng(5), []
    for _ in range(200):
        a = rng.integers(0, 1 << 63, rng.integers(0, 900)).astype(np.uint64)
        b = np.concatenate([a[: rng.integers(0, len(a) + 1)], rng.integers(0, 1 << 63, rng.integers(0, 900)).astype(np.uint64)])
        rows += [(setjoin.parities(a).tolist(), setjoin.parities(x).tolist(), len(np.setxor1d(a, x))) for x in (a, b)]
    for r in spark.createDataFrame(rows, "a array<long>, b array<long>, n long").withColumn("found", setjoin.differing(F.col("a"), F.col("b"))).collect():
        assert r.found <= r.n
        if len(r.a) == len(r.b):
            assert r.found == sum((x ^ y).bit_count() for x, y in zip(np.array(r.a).view(np.uint64).tolist(), np.array(r.b).view(np.uint64).tolist()))


def test_groups_equal_those_of_all_similar_pairs(spark, tmp_path):
    """Links that are confirmed are not lost behind such as are not, nor where fingerprints differ too much (F8)."""
    rng = random.Random(8)
    texts = _near_copies(rng, [f"v{i}" for i in range(3000)], (9, 20, 70, 70, 140, 140, 210, 300, 300, 500), 30)
    texts += ["", " ", "\n\t", None]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect())
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for t in texts]
    group = list(range(len(sets)))
    for b in range(len(sets)):
        for a in range(b):
            if group[a] != group[b] and _similar(sets[a], sets[b]):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    assert kept == sorted(set(group))


@pytest.mark.parametrize("max_bucket", [8192, 30])
@pytest.mark.parametrize("flush", [1 << 18, 5])
def test_pairs_of_a_shared_passage_do_not_grow_with_the_square(spark, max_bucket, flush, monkeypatch):
    """Texts with one passage in common, four times as many: pairs grow with the texts, and no similar pair is lost."""
    monkeypatch.setattr(setjoin, "FLUSH", flush)
    made = {}
    for size in (80, 320):
        rng = random.Random(size)
        passage = [f"p{i}" for i in range(40)]
        texts = [" ".join(rng.choices([f"v{i}" for i in range(5000)], k=60) + passage) for _ in range(size)]
        texts += _near_copies(rng, [f"u{i}" for i in range(3000)], (60,) * (size // 20), 4)
        texts += [" ".join(passage + t.split()[:1]) for t in texts[:25]]
        sets = [np.unique(simhash.shingle_hashes(t, 5)) for t in texts]
        none = np.empty(0, np.uint64)
        rows = [(i, len(h), setjoin.prefix(h, none, none, (4, 5)).view(np.int64).tolist(), i, h.view(np.int64).tolist()) for i, h in enumerate(sets)]
        table = spark.createDataFrame(rows, "node long, n long, prefix array<long>, c long, h array<long>").repartition(3)
        whole = lambda nodes: table.join(nodes, "node", "left_semi").select("node", "h")  # noqa: B023, E731
        met = [(r.a, r.b) for r in setjoin.meeting(table, (4, 5), max_bucket, whole).collect()]
        of = [set(h.tolist()) for h in sets]
        similar = {(a, b) for b in range(len(of)) for a in range(b) if _similar(of[a], of[b])}
        assert len(met) == len(set(met)) and similar <= set(met)
        made[size] = len(met) - len(similar)
        assert made[size] <= setjoin.CROWD * sum(len(r[2]) for r in rows) and (size < 100 or len(similar) > 300)
    assert made[320] <= 6 * max(made[80], 320)
