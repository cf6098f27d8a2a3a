"""Reads are scored, filtered and searched once, and short reads make short stretches."""

import numpy as np

from fluvia.operators import reads, scores, trimming

READS = "sample_id string, read_id string, sequence string, quality string"
ROWS = [("s", str(i), "A" * (10 + i), chr(40 + i) * (10 + i)) for i in range(30)]


def test_short_texts_are_not_padded_to_long_stretches(monkeypatch):
    sizes, scan = [], trimming._scan
    monkeypatch.setattr(trimming, "_scan", lambda cells, *rest: sizes.append(cells.shape[0]) or scan(cells, *rest))
    texts = [np.frombuffer(b"TTTACGTACGTTT", np.uint8), np.zeros(0, np.uint8), np.frombuffer(b"GG", np.uint8)]
    text, end, distance = trimming.occurrences(texts, b"ACGTACG", 1)
    assert max(sizes) == 7 + 1 + 13 and (0, 10, 0) in set(zip(text.tolist(), end.tolist(), distance.tolist()))


def test_best_reads_of_chosen_columns_are_the_same(spark):
    own = scores.scored(spark.createDataFrame(ROWS, READS), window=5)
    whole = scores.keep_best(own, ["sample_id"], percent=50)
    few = scores.keep_best(own, ["sample_id"], percent=50, columns=["read_id"])
    assert few.columns == ["read_id"] and sorted(r.read_id for r in few.collect()) == sorted(r.read_id for r in whole.collect())
    assert "ArrowEvalPython" not in few._jdf.queryExecution().toString()  # scored before it is read for each step


def test_a_preset_filters_once(spark):
    f = reads.ReadFilter(9.0, 12, keep_percent=50)
    own = spark.createDataFrame(ROWS, READS)
    few, whole = reads.apply_preset(own, ["sample_id"], f, ["read_id"]), reads.apply_preset(own, ["sample_id"], f)
    assert few.columns == ["read_id"] and sorted(r.read_id for r in few.collect()) == sorted(r.read_id for r in whole.collect())
    assert "ArrowEvalPython" not in few._jdf.queryExecution().toString()


def test_mean_quality_is_no_expression_over_letters(spark):
    plan = spark.createDataFrame(ROWS, READS).select(reads.mean_quality(reads.F.col("quality")).alias("q"))
    assert "transform(" not in plan._jdf.queryExecution().toString()
    for (q,), (_, _, _, text) in zip(plan.collect(), ROWS):
        assert abs(q - (ord(text[0]) - 33)) < 1e-9
