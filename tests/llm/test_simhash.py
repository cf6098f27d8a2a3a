"""SimHash components against all pairs."""

import random

import pytest

from fluvia.llm import simhash


def components(fps):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= simhash.RADIUS:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(fps))]


def test_masks_cover_every_small_difference():
    rng = random.Random(1)
    masks = simhash.covering_masks()
    assert len(masks) == 31
    for _ in range(2000):
        diff = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
        assert any(diff & m == 0 for m in masks)


@pytest.mark.parametrize("max_bucket", [20_000, 5])
def test_components_equal_all_pairs(spark, max_bucket):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(50)]
    bases = [rng.choices(words, k=rng.randint(1, 200)) for _ in range(12)]
    texts = []
    for _ in range(150):
        t = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            t[rng.randrange(len(t))] = rng.choice(words)
        texts.append(" ".join(t))
    texts += ["", None, "\n\t", "a", "A"]
    ids = list(range(1000, 1000 + len(texts)))
    rng.shuffle(ids)
    order = sorted(range(len(ids)), key=ids.__getitem__)
    ids, texts = [ids[i] for i in order], [texts[i] for i in order]
    docs = spark.createDataFrame(list(zip(ids, texts, ids)), "doc_id long, text string, fp long").repartition(4)
    found = {r.doc_id: r for r in simhash.near_duplicates(docs, max_bucket=max_bucket).collect()}
    fps = [simhash.fingerprint(t) for t in texts]
    for i, c in enumerate(components(fps)):
        assert found[ids[i]].component_id == ids[c]
        assert found[ids[i]].fp % 2**64 == fps[i]


def test_null_ids_repeated_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (None, "q r s t u v w")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in simhash.near_duplicates(docs).collect()) == [(0, 0), (0, 3), (3, 3), (3, 3)]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_wide_links_equal_all_pairs(spark):
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(400)]
    bases = [rng.choices(vocabulary, k=n) for n in (6, 7, 30, 120, 300, 300)]
    texts = []
    for _ in range(160):
        t = list(rng.choice(bases))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            t[rng.randrange(len(t))] = rng.choice(vocabulary)
        texts.append(" ".join(t))
    texts += [" ".join(rng.choices(vocabulary, k=rng.randint(1, 9))) for _ in range(100)]
    hashes = {simhash.majority(h): h for h in (simhash.shingle_hashes(t, 5) for t in texts)}
    rows = [(simhash._signed(fp), i, simhash._signed(simhash.minima(h))) for i, (fp, h) in enumerate(hashes.items())]
    for limit in (20_000, 5):
        linked = spark.createDataFrame(rows, "fp long, id long, s long").repartition(3)
        found = [(r.a, r.b) for r in simhash.links(linked, max_bucket=limit, wide=True).collect()]
        group = list(range(len(rows)))
        for a, b in found:
            (fa, _, sa), (fb, _, sb) = rows[a], rows[b]
            assert ((fa ^ fb) % 2**64).bit_count() <= simhash.WIDE_RADIUS and ((sa ^ sb) % 2**64).bit_count() <= simhash.SKETCH_RADIUS
            old, new = max(group[a], group[b]), min(group[a], group[b])
            group = [new if g == old else g for g in group]
        for a in range(len(rows)):
            for b in range(a):
                (fa, _, sa), (fb, _, sb) = rows[a], rows[b]
                if ((fa ^ fb) % 2**64).bit_count() <= 9 and ((sa ^ sb) % 2**64).bit_count() <= simhash.SKETCH_RADIUS:
                    assert group[a] == group[b]


def test_one_bit_minima_tell_short_texts_apart():
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10_000)}" for _ in range(rng.randint(1, 7))) for _ in range(300)]
    s = [simhash.minima(simhash.shingle_hashes(t, 5)) for t in texts]
    assert all((a ^ b).bit_count() > simhash.SKETCH_RADIUS for i, a in enumerate(s) for b in s[:i])
