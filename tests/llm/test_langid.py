"""Profiles and distances against a plain count, and accuracy on rows that were held out."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fluvia.llm import langid

SF_DIR = "/root/testdata/sf0.01"


def grams(text):
    words = "".join(c.lower()[0] if c.isalpha() else " " for c in text).split()
    return Counter(w[i : i + n] for w in (f" {w} " for w in words) for n in range(1, 6) for i in range(len(w) - n + 1) if w[i : i + n] != " ")


@pytest.mark.parametrize("text", ["Hello, world hello", "", "...", "éa É1b", "a" * 9, "one two  three\nfour"])
def test_ngrams_are_counted(text):
    other = "beside it"
    owner, code = langid.ngrams([other, text, None, other])
    own = [sorted(Counter(code[owner == i].tolist()).values()) for i in range(4)]
    assert own == [sorted(grams(t).values()) for t in (other, text, "", other)]


def test_out_of_place_distance():
    profiles = {"x": langid.ranked(["abc abd abe"])[1].tolist(), "y": langid.ranked(["zz zy zx"])[1].tolist()}
    gap, n = langid.distances(["abc abd abe", "zz zy zx", "", "12"], profiles)
    assert gap[0, 0] == 0 and gap[1, 1] == 0 and (gap[2:] == 0).all() and (n[2:] == 0).all()
    _, code, rank = langid.ranked(["abc ab"])
    place = {c: i for i, c in enumerate(profiles["x"])}
    expected = sum(abs(place[c] - r) if c in place else langid.SIZE for c, r in zip(code.tolist(), rank.tolist()))
    assert langid.distances(["abc ab"], profiles)[0][0, 0] == expected


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, "hello there my friend", "en", 1), (2, "guten tag mein freund", "de", 1), (3, None, "en", 1), (None, "42", None, 1), (5, "hello hello", None, 1)], "doc_id long, text string, lang string, score int")
    profiles = langid.learn(docs)
    assert list(profiles) == ["de", "en"]
    found = langid.predict(docs, profiles, names=("p", "s")).select("doc_id", "p", "s").collect()
    assert {r.doc_id: r.p for r in found} == {1: "en", 2: "de", 3: "und", None: "und", 5: "en"}
    assert all(0 <= r.s <= 1 for r in found)
    assert {r.lang_pred for r in langid.predict(docs.select("doc_id", "text"), {}).collect()} == {"und"}
    assert langid.learn(docs.limit(0)) == {}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables here")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = langid.op5_langid(spark, SF_DIR).join(docs.filter("lang is not null").select("doc_id", "lang"), "doc_id").filter("held_out and lang_pred <> 'und'")
    right, n = found.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 200 and right / n > 0.95
