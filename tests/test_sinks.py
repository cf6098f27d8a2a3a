"""Report text, JSON bodies and manifests on small fixtures."""

import json

from pyspark.sql import functions as F

from fluvia.operators import kmer
from fluvia.sources import sinks


def test_percent_text_rounds_halves_up_and_survives_zero(spark):
    rows = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (5, 5), (0, 7), (3, 0), (1, 800)], "a long, b long")
    got = [r.p for r in rows.select(sinks.percent_text(F.col("a"), F.col("b")).alias("p")).collect()]
    assert got == ["12.50", "33.33", "66.67", "100.00", "0.00", "0.00", "0.13"]


def test_texts_keep_their_order(spark, tmp_path):
    rows = [("s", i, f"line {i}") for i in range(30)]
    sinks.write_texts(spark.createDataFrame(rows[::-1], "sample_id string, row_no int, value string"), str(tmp_path / "t"))
    (part,) = (tmp_path / "t" / "sample_id=s").glob("*.txt")
    assert part.read_text().splitlines() == [v for _, _, v in rows]


def test_json_bodies_follow_the_order(spark):
    rows = spark.createDataFrame([("s", 2, "b"), ("s", 1, "a"), ("t", 1, None)], "sample_id string, row_no int, name string")
    got = {r.sample_id: r for r in sinks.json_bodies(rows, ["sample_id"], "row_no", "batch", False).collect()}
    assert json.loads(got["s"].body) == [{"name": "a"}, {"name": "b"}]
    assert json.loads(got["t"].body) == [{}]
    assert json.loads(got["s"].sidecar) == {"mode": "batch", "is_cumulative": False, "rows": 2}


def test_manifest_tells_none_failed_from_unknown(spark):
    samples = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "run_id int, sample_id string")
    produced = spark.createDataFrame([(1, "b"), (2, "c")], "run_id int, sample_id string")
    old = spark.createDataFrame([(1, "then", ["b"]), (4, "x", None)], "run_id int, started_at string, failed array<string>")
    got = {r.run_id: r for r in sinks.manifest(samples, produced, [".x"], F.lit("now"), old).collect()}
    assert (got[1].started_at, got[1].failed, got[1].files) == ("then", ["a"], ["a.x", "b.x"])
    assert (got[2].started_at, got[2].failed) == ("now", [])
    assert got[3].failed is None
    assert set(got) == {1, 2, 3}


def test_equal_scores_go_to_the_lesser_taxid(spark):
    tax = spark.createDataFrame([("1", None), ("20", "1"), ("3", "1")], "taxid string, parent string")
    table = spark.createDataFrame([("AC", "3"), ("CG", "20")], "kmer string, taxid string")
    got = kmer.classify(spark.createDataFrame([("r", "ACG"), ("n", "TT")], "read_id string, sequence string"), table, tax, 2).collect()
    assert {(r.read_id, r.status, r.taxid) for r in got} == {("r", "C", "20"), ("n", "U", "0")}
