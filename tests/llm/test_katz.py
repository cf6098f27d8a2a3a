"""Katz scores against a direct evaluation in plain Python, and the model's sums."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluvia.llm import katz
from fluvia.llm.common import crc_bucket


def tokens_of(text):
    return [*((text or "").encode().lower().split()), b""]


def ratios(counts, k=5):
    n = Counter(counts.values())
    if all(n[r] for r in range(1, k + 2)):
        top = (k + 1) * n[k + 1] / n[1]
        d = {r: ((r + 1) * n[r + 1] / (r * n[r]) - top) / (1 - top) for r in range(1, k + 1)}
        if all(0 < x < 1 for x in d.values()):
            return {r: r * x for r, x in d.items()}
    cut = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    return {r: r - cut for r in range(1, k + 1)}


def brute(rows):
    """[(base, score, known, tokens)] by row; every probability is looked up token by token, order by order."""
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    train = [tokens_of(t) for (i, t), h in zip(rows, held) if i is not None and not h]
    c = Counter(w for t in train for w in t)
    total = sum(c.values())
    small = ratios(c)
    kept = sum(small.get(x, x) for x in c.values()) / max(total, 1)
    f = 1 if kept < 1 - 1e-12 else total / (total + 1) / kept
    p = lambda w: f * small.get(c[w], c[w]) / total if c[w] else 1 - f * kept
    pairs, triples = Counter(), Counter()
    for t in train:
        past = [b""]
        for w in t:
            pairs[past[-1:][0], w] += 1
            if len(past) > 1:
                triples[past[-2], past[-1], w] += 1
            past.append(w)
    tables = {}
    for n, grams in ((1, pairs), (2, triples)):
        after = defaultdict(dict)
        for g, x in grams.items():
            after[g[:-1]][g[-1]] = x
        tables[n] = (ratios(grams), after)

    known = {}

    def conditional(h, w):
        """P(w | h), by the lower order where h w was not seen."""
        if not h:
            return p(w)
        small, after = tables[len(h)]
        seen = after.get(h)
        if not seen:
            return conditional(h[1:], w)
        if h not in known:
            n = sum(seen.values())
            kept = sum(small.get(x, x) for x in seen.values()) / n
            f = 1 if kept < 1 - 1e-12 else n / (n + 1) / kept
            known[h] = n, f, (1 - f * kept) / (1 - sum(conditional(h[1:], x) for x in seen))
        n, f, rest = known[h]
        return f * small.get(seen[w], seen[w]) / n if w in seen else rest * conditional(h[1:], w)

    unknown = object()
    c[unknown] = 0
    for n in (1, 2):
        for h in list(tables[n][1])[:8]:
            assert math.isclose(sum(conditional(h, w) for w in c), 1, rel_tol=1e-8)
    del c[unknown]
    out = []
    for _, t in rows:
        past, score, base = [b""], 0.0, 0.0
        for w in tokens_of(t):
            score += math.log10(conditional(tuple(past[-2:]), w))
            base += math.log10((c[w] + 0.1) / (total + 0.1 * (len(c) + 1)))
            past.append(w)
        out.append((base, score, sum(c[w] > 0 for w in tokens_of(t)), total))
    return out


def rows_of(n, seed=3):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcde", k=rng.randint(1, 5))) for _ in range(120)]
    out = [(i, " ".join(rng.choices(vocab, [1 / (j + 1) for j in range(120)], k=rng.randint(0, 60)))) for i in range(n)]
    return out + [(n, None), (n + 1, ""), (n + 2, "A  b\tC d Ä unseenword"), (None, "a b c"), (1, out[1][1])]


@pytest.mark.parametrize(("n", "bucket_bytes"), [(150, 16 << 20), (150, 500), (3, 500)])
def test_scores_equal_the_recursion(spark, n, bucket_bytes):
    """With few buckets, with many (so that frequent words are split), and with hardly any text."""
    rows = rows_of(n)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = katz.score(docs, crc_bucket(F.col("doc_id"), 10) == 0, slice_bytes=2000, bucket_bytes=bucket_bytes, least_buckets=4).collect()
    expected = defaultdict(list)
    for (i, _), x in zip(rows, brute(rows)):
        expected[i].append(x)
    assert len(found) == len(rows)
    for r in found:
        base, score, known, total = expected[r.doc_id].pop()
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(r.score, score, rel_tol=1e-9, abs_tol=1e-9)
        assert (r.n_known, r.train_tokens) == (known, total)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert [r.score for r in katz.score(docs, crc_bucket(F.col("doc_id"), 10) == 0, least_buckets=4).collect()] == [0.0, 0.0]
    assert katz.score(docs.limit(0), crc_bucket(F.col("doc_id"), 10) == 0, least_buckets=4).count() == 0


def test_packed_integers_come_back():
    for kind in (np.uint32, np.uint64, float):
        for differences in (False, True)[: 1 + (kind is not float)]:
            x = np.array([5, 3, 2**31, 0, 7], kind)
            assert (katz.unpack(katz.pack(x, differences), kind, differences) == x).all()
            assert len(katz.unpack(katz.pack(x[:0], differences), kind, differences)) == 0


def test_every_taught_word_has_pairs_of_its_own(spark):
    rng, fresh, rows = random.Random(5), iter(range(10**9)), []
    for i in range(64):  # over 2**17 distinct taught words
        own = [f"w{next(fresh)}" for _ in range(2400)]
        rows.append((i, " ".join([*own, *own[:300], *rng.choices(["a", "b", "c"], k=50)])))
    assert sum(2400 for i, _ in rows if zlib.crc32(str(i).encode()) % 10) > 1 << 17
    rows += [(100 + i, " ".join(rows[i][1].split()[k : k + 40])) for i in range(30) for k in (0, 2380)][::7]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {(r.doc_id, r.n_tokens): r.score for r in katz.score(docs, crc_bucket(F.col("doc_id"), 10) == 0, slice_bytes=100_000, least_buckets=8).collect()}
    for (i, t), (_, score, _, _) in zip(rows, brute(rows)):
        assert math.isclose(found[i, len(t.split()) + 1], score, rel_tol=1e-9), i
