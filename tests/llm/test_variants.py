"""Spelling variants against all pairs of words."""

import os
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from fluvia.llm import variants

SF_DIR = "/root/testdata/sf0.001"


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts, least_letters=7, least_count=2, ratio=10):
    words = {w: n for w, n in counts.items() if len(w) >= least_letters and n >= least_count}
    beside = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if near(a, b):
            beside[a].append(b)
            beside[b].append(a)
    best = {w: min(x, key=lambda v: (-words[v], v)) for w, x in beside.items() if x}
    form = {w: v for w, v in best.items() if words[v] >= ratio * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(beside[w]), words[form[w]] if w in form else None) for w, n in words.items())


def told(found):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect())


def test_all_pairs(spark):
    rng = random.Random(4)
    counts = Counter()
    for _ in range(60):
        w = "".join(rng.choices("abé", k=rng.randint(3, 9)))
        for _ in range(12):
            at, c = rng.randrange(len(w) + 1), rng.choice("abé÷")
            counts[rng.choice([w, w[:at] + c + w[at:], w[:at] + c + w[at + 1 :], w[:at] + w[at + 1 :]])] += rng.choice([1, 2, 3, 20, 25, 400, 5000])
    rows = [(w, n - 1, "x") for w, n in counts.items()] + [(w, 1, "y") for w in counts] + [(None, 9, "z")]
    table = spark.createDataFrame(rows, "word string, n int, form string").repartition(3)
    for letters in (1, 5):
        assert told(variants.group_variants(table, least_letters=letters)) == plain(counts, letters)
    assert told(variants.group_variants(table.limit(0))) == []


def test_chains_and_doubled_letters(spark):
    counts = {"aaaaaaaa": 3, "aaaaaaa": 30, "aaaaaaab": 300, "aaaaaabb": 3000, "aaaaabbb": 30000, "aaaabbbb": 300000, "bbbbbbb": 2, "ccccccc": 1, "aaaaaaaaa": 2}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = told(variants.group_variants(table))
    assert found == plain(counts)
    assert dict((r[0], r[2]) for r in found)["aaaaaaaa"] == "aaaabbbb"


def test_long_words(spark):
    long = "abcdefgh" * 4000
    counts = {long: 50, long[:9000] + "z" + long[9001:]: 5, long[1:]: 2, long + "h": 2, long[:-1] + "gh": 2}
    assert told(variants.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == plain(counts)


def test_groups_span_batches(spark):
    """Groups are whole where Arrow batches end within them."""
    counts = {f"common{a}{b}": 2 + i for i, (a, b) in enumerate((a, b) for a in "abcdefghij" for b in "abcdefghij")}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert told(variants.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == plain(counts)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def counted(rows, every):
    counts = Counter()
    for ident, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if ident is None else ident}:{w}".encode())
            if h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    return counts


def test_words_of_texts(spark):
    rows = [(1, "ÀBCDEFGH àbcdefgh 12ABCDEFGHé×÷"), (1, "ÀBCDEFGH àbcdefgh 12ABCDEFGHé×÷"), (2, None), (3, ""), (None, "abcdefg hijklmnop"), (4, "x" * 20000), (5, "ÀBCDEFGHß " * 40)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, word string")
    for every in (1, 2, 31):
        found = {r.word: r.n for r in variants.word_counts(docs, typo_every=every).collect()}
        assert found == {w: n for w, n in counted(rows, every).items() if len(w) >= 7}
    assert variants.word_counts(docs.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables here")
def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    counts = counted(docs, 31)
    found = told(variants.op12_variants(spark, SF_DIR))
    assert {r[0]: r[3] for r in found} == {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    assert found == plain(counts)
