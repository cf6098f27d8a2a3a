"""Counts of the quality rules against plain Python and the SQL."""

import re
from collections import Counter

import duckdb

from fluvia.llm import quality

TEXTS = ["", None, "one", "a b c d e a b c d e x", "a b c d e f\n\n a b c d e f\nx\nx\nx", "#tag $5 100% <b> & |", "á é í\tó ú !!", "w " * 40, "the cat " * 3 + "sat on a mat and the dog ran to it", "x" * 5000, "a b c d a b c d a b c d", "line one\r\nline one\r\n"]


def brute(text):
    text = text or ""
    words = re.findall(quality.WORD, text)
    lines = [x for x in text.split("\n") if re.search(quality.WORD, x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(5)}
    symbols = sum(text.count(c) for c in quality.SYMBOLS)
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), failed


def test_counts(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words int")
    out = quality.judge(docs)
    found = {r.doc_id: r for r in out.collect()}
    for i, t in enumerate(TEXTS):
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t), i
        assert not (r.base_failed and r.kept)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas())
    expected = con.sql(quality.OP6_SQL)
    assert {r[0]: r for r in expected.fetchall()} == {r.doc_id: tuple(r[c] for c in expected.columns) for r in found.values()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_null_ids_repeated_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "doc_id long, text string")
    assert quality.judge(docs).count() == 3
    assert quality.judge(docs.limit(0)).count() == 0
