"""Adapters with errors and scores of reads against plain searches."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluvia.operators import scores, trimming


def plain_ends(text, adapter):
    """E(adapter, j) for j = 1, 2, ... by the table of edit distances."""
    column, out = list(range(len(adapter) + 1)), []
    for c in text:
        new = [0]
        for i, a in enumerate(adapter, 1):
            new.append(min(column[i] + 1, new[i - 1] + 1, column[i - 1] + (a != c)))
        column = new
        out.append(column[-1])
    return out


@pytest.mark.parametrize("size, errors", [(1, 0), (5, 2), (22, 5), (64, 16)])
def test_occurrences_equal_the_table(size, errors):
    rng = random.Random(size)
    adapter = "".join(rng.choices("ACGT", k=size))
    texts = ["".join(rng.choices("ACGT", k=n)) for n in (0, 1, size, 511, 512, 513, 1500)]
    for n in (500, 1100):  # adapters with errors over the stretches' borders
        body = list("".join(rng.choices("ACGT", k=n)))
        for at in (505, 20):
            copy = list(adapter)
            copy[rng.randrange(size)] = "N"
            body[at:at] = copy
        texts.append("".join(body))
    text, end, distance = trimming.occurrences([np.frombuffer(t.encode(), np.uint8) for t in texts], adapter.encode(), errors)
    got = sorted(zip(text.tolist(), end.tolist(), distance.tolist()))
    assert got == [(i, j, d) for i, t in enumerate(texts) for j, d in enumerate(plain_ends(t, adapter), 1) if d <= errors]
    assert got


def test_small_blocks_give_the_same(monkeypatch):
    rng = random.Random(5)
    texts = [np.frombuffer("".join(rng.choices("ACGT", k=n)).encode(), np.uint8) for n in (3000, 10, 900, 0, 5000)]
    one = trimming.occurrences(texts, b"ACGTTA", 1)
    monkeypatch.setattr(trimming, "_CELLS", 2000)
    assert all((a == b).all() for a, b in zip(one, trimming.occurrences(texts, b"ACGTTA", 1)))


def test_adapters_that_cannot_be():
    for a, e in ((b"", 0), (b"A" * 65, 1), (b"AC", 2)):
        with pytest.raises(ValueError):
            trimming.occurrences([], a, e)


def test_reads_are_cut_and_split(spark):
    rng = random.Random(2)
    adapter = "GGTTACGTCCATTGCATTAC"
    wrong = adapter[:9] + adapter[10:]
    a, b = ("".join(rng.choices("AC", k=n)) for n in (400, 300))
    rows = [("whole", a), ("head", "TG" + wrong + a), ("tail", a + wrong + "GT"), ("both", adapter + a + adapter), ("inner", a + adapter + b), ("short", a + adapter + b[:50] + adapter + b), ("only", adapter), ("empty", ""), ("none", None)]
    reads = spark.createDataFrame([(i, s, s) for i, s in rows], "read_id string, sequence string, quality string")
    got = sorted((r.read_id, r.piece, r.sequence, r.quality) for r in trimming.split_reads(reads, [adapter], window=60, least=100).filter("read_id <> 'none'").collect())
    want = [("both", a), ("empty", ""), ("head", a), ("inner", a), ("inner", b), ("only", ""), ("short", a), ("short", b), ("tail", a), ("whole", a)]
    assert [(i, s) for i, _, s, _ in got] == want and all(s == q for *_, s, q in got)
    assert [(p) for i, p, *_ in got if i == "inner"] == [1, 2]
    (none,) = trimming.split_reads(reads, [adapter]).filter("read_id = 'none'").collect()
    assert (none.piece, none.sequence) == (1, None)
    assert trimming.split_reads(reads.limit(0), [adapter]).count() == 0


def test_scores_and_the_best_equal_a_plain_search(spark):
    rng = random.Random(4)
    rows = [(rng.choice("xyz") if i % 9 else None, f"r{i:03}", "".join(chr(33 + rng.randrange(5, 40)) for _ in range(rng.choice([1, 3, 40, 249, 250, 251, 900])))) for i in range(150)]
    rows += [("x", f"c{i}", "5" * 100) for i in range(40)]  # equal scores
    reads = spark.createDataFrame([(k, i, q, q) for k, i, q in rows], "k string, read_id string, sequence string, quality string")
    known = {}
    for k, i, q in rows:
        p = [10 ** (-(ord(c) - 33) / 10) for c in q]
        w = min(250, len(p))
        mean, worst = 100 - 100 * sum(p) / len(p), 100 - 100 * max(sum(p[j : j + w]) for j in range(len(p) - w + 1)) / w
        known[i] = mean, worst, (100 * len(p) / (len(p) + 5000) * mean) ** 0.5 * worst / mean
    own = scores.scored(reads).cache()
    for r in own.collect():
        assert (r.mean_q, r.window_q, r.score) == pytest.approx(known[r.read_id], abs=1e-6)
    exact = {r.read_id: r.score for r in own.collect()}
    for percent, target in ((50, None), (None, 2000), (80, 3000), (None, None), (0, None), (100, None)):
        want = set()
        for key in ("x", "y", "z", None):
            mine = sorted(((-exact[i], i, len(q)) for k, i, q in rows if k == key))
            bound = min([sum(n for *_, n in mine) * percent / 100] if percent is not None else [float("inf")])
            bound, so_far = min(bound, target if target is not None else float("inf")), 0
            for _, i, n in mine:
                if so_far < bound:
                    want.add(i)
                so_far += n
        got = [r.read_id for r in scores.keep_best(own, ["k"], percent, target).collect()]
        assert len(got) == len(set(got)) and set(got) == want, (percent, target)
    assert scores.keep_best(own, ["k"], min_window_q=100.5).count() == 0
    none = scores.scored(spark.createDataFrame([("k", "a", "", ""), ("k", "b", None, None)], reads.schema)).select(F.sum("score")).first()[0]
    assert none == 0
