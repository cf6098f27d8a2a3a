"""The pipeline's stages one by one, on a small fixture and on odd tables."""

import random

import numpy as np
import pytest

import corpus_pipeline
from fluvia.llm import bpe, simhash

DE, EN = "der hund und die katze sind im garten und schlafen nicht", "the dog and the cat are in the garden and do not sleep"


def _id(r):
    return -1 if r.doc_id is None else r.doc_id


def documents(spark):
    rows = [(i, f"{EN} number {i} {i * 7} {i * i}\n" + "\n".join(f"row {i} {j} {i * j}" for j in range(12)), "en", "web", 1) for i in range(12)]
    rows += [(20 + i, f"{DE} nummer {i * 31} {i} {i + 5}", "de", "news", 1) for i in range(6)]
    rows += [(40, rows[0][1], "en", "web", 1), (41, None, "en", "web", 1), (42, "12 34", "en", "web", 1), (None, EN + " x", "en", None, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark, tmp_path):
    documents(spark).coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "bpe":
            assert out.columns == docs.columns
        kept.append(sorted(_id(r) for r in out.select("doc_id").collect()))
        docs = out
    ids = [-1, *range(12), *range(20, 26), 40]
    assert kept[0] == ids and kept[1] == ids
    assert 0 in kept[2] and set(kept[2]) <= set(ids) and len(set(kept[2])) == len(kept[2])
    assert set(kept[3]) == set(kept[2])
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(_id(r) for r in whole) == kept[4]
    codec = bpe.Codec(open(bpe.default_path(), "rb").read())
    own = {r.doc_id: codec.decode(r.ids) for r in whole}
    assert own[None] == EN + " x" and all(r.n_tokens == len(np.frombuffer(r.ids, "<u4")) for r in whole)
    sets = {i: set(simhash.shingle_hashes(t, 5).tolist()) for i, t in own.items() if i is not None}
    assert all(len(sets[a] & sets[b]) < 0.8 * len(sets[a] | sets[b]) for a in sets for b in sets if a < b)


def test_near_duplicates_are_confirmed(spark, tmp_path):
    """No row goes without a partner of 0.8 in its group, and nearly no such pair stays."""
    rng = random.Random(31)
    vocabulary = [f"v{i}" for i in range(3000)]
    rows = []
    for n in (3, 8, 40, 120, 120, 300, 300, 600):
        base = rng.choices(vocabulary, k=n)
        for k in range(40):
            t = list(base)
            for _ in range(rng.randint(0, max(1, n // 20))):
                t[rng.randrange(n)] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(t)))
    rows += [(500, None), (501, ""), (502, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()}
    sets = {i: set(simhash.shingle_hashes(t, 5).tolist()) for i, t in rows}
    near = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    group = {i: i for i in sets}
    close = [(a, b) for a in sets for b in sets if a < b and near(a, b)]
    for a, b in close:
        old, new = max(group[a], group[b]), min(group[a], group[b])
        if old != new:
            group = {i: new if g == old else g for i, g in group.items()}
    assert {group[i] for i in kept} == set(group.values())  # each true group keeps one at least
    assert all(any(near(i, j) for j in sets if j != i) for i in sets if i not in kept)
    assert len(kept) <= 1.05 * len(set(group.values())) and sum(a in kept and b in kept for a, b in close) <= 0.01 * len(close)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_tables(spark, tmp_path, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, component_id long, _block int, _key long, first_id long, Epoch int, _text int"
    rows = [(None,) * 13, (1, "", "en", "s", 0, 1.0, "x", 1, 1, 1, 1, 1, 1), (1, "", "en", "s", 0, 1.0, "x", 1, 1, 1, 1, 1, 1), (2, EN, "en", "s", 0, 1.0, "x", 1, 1, 1, 1, 1, 1)]
    odd = spark.createDataFrame(rows, schema)
    out = stage(spark, odd, str(tmp_path))
    assert 2 in {r.doc_id for r in out.select("doc_id").collect()}
    assert name == "bpe" or out.columns == odd.columns
    assert stage(spark, odd.limit(0), str(tmp_path)).count() == 0


def test_unrelated_texts_of_one_id_stay(spark, tmp_path):
    texts = [f"{x} one two three {x * 7} four five {x * x} six seven eight {x + 3}" for x in range(5)]
    rows = [(1, texts[0], "web"), (1, texts[1], "web"), (2, texts[1], "web"), (3, texts[2], "web"), (3, texts[2], "web"), (0, texts[3], "web"), (9, texts[3], "news"), (None, texts[3], "web")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    out = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()
    assert sorted((_id(r), r.text) for r in out) == sorted([(-1, texts[3]), (0, texts[3]), (1, texts[0]), (1, texts[1]), (3, texts[2])])


def test_shingles_can_be_chosen(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    (row,) = simhash.near_duplicates(docs, words=5).collect()
    assert row.fp % 2**64 == simhash.fingerprint("a b c d e f g", 5) != simhash.fingerprint("a b c d e f g")
