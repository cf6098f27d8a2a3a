"""Removed bytes against a table of all substrings."""

import random
from collections import Counter

import numpy as np
import pytest

from fluvia.llm import repeats


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if count[r[i : i + length]] > 1:
                gone[i : i + length] = True
        edge = np.diff(gone.astype(np.int8), prepend=0, append=0)
        out.append((len(r), list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())), bytes(np.frombuffer(r, np.uint8)[~gone])))
    return out


def texts_of(seed, length, n=60):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choices("abc é", k=k))
    shared = [word(rng.randint(length // 2, 3 * length)) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [word(rng.randint(0, 2 * length))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), word(rng.randint(0, length))]
        out.append("".join(parts))
    return [*out, None, "", "x" * (length - 1), "a" * (5 * length), "ab" * (3 * length), out[0], out[0][3:]]


@pytest.mark.parametrize(("length", "gram", "hot", "batch"), [(40, 8, 4096, 8 << 20), (40, 8, 3, 2000), (41, 9, 1, 2000), (60, 12, 4096, 500)])
def test_removed_bytes(spark, length, gram, hot, batch):
    texts = texts_of(length + hot, length)
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, k1 int").repartition(5)
    found = {r.doc_id: r for r in repeats.remove_repeats(docs, length=length, gram=gram, hot=hot, batch_bytes=batch).collect()}
    assert len(found) == len(texts)
    for i, (size, spans, kept) in enumerate(brute(texts, length)):
        r = found[i]
        assert (r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) == (size, spans, kept), i


def test_repeated_rows_null_ids_and_no_rows(spark):
    text = "".join(map(str, range(200)))
    rows = [(1, text), (1, text), (None, "short"), (2, text[:250] + "!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeats.remove_repeats(docs).collect()
    assert sorted((r.doc_id or 0, len(r.kept)) for r in found) == [(0, 5), (1, 0), (1, 0), (2, 1)]
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_many_rows_of_one_text_cost_one(spark):
    text = " ".join(str(i * i) for i in range(1200))
    docs = spark.createDataFrame([(None, text)] * 2000 + [(7, text)] * 100 + [(8, "own " + text[:300])], "doc_id long, text string").repartition(4)
    found = repeats.remove_repeats(docs).collect()
    assert len(found) == 2101 and sum(len(r.kept) for r in found) == 4 and {r.n_bytes for r in found} == {len(text), 304}


def test_pieces_cover_each_window_once():
    data = np.frombuffer(("abcab" * 90 + "".join(map(str, range(300)))).encode(), np.uint8)
    p = repeats.pieces_of(data, np.array([0, 400, len(data)]), 50, 8)
    windows = [s + o for o, s, size, n in zip([0, 400][0] * np.ones(len(p["start"]), int) + 400 * (p["owner"] == 1), p["start"], p["size"], p["n"]) for s in range(s, s + n * (size - 49))]
    assert sorted(windows) == [i for i in range(len(data) - 49) if (i < 400) == (i + 49 < 400)]
