"""Roots of a run's files and budgets of time."""

from pyspark.sql import functions as F

from fluvia.operators import inputs


def test_structure_of_roots(spark):
    files = [("run/barcode01/a.fastq",), ("run/other/b.fastq",), ("flat/c.fastq.gz",), ("deep/x/barcode1/readme.txt",), ("deep/x/y.fq",)]
    df = spark.createDataFrame(files, "path string")
    own = {r.root: r.structure for r in inputs.structure(df, spark.createDataFrame([("run",), ("flat",), ("deep/x",), ("missing",)], "root string")).collect()}
    assert own == {"run": "barcode_subdirs", "flat": "flat", "deep/x": "flat", "missing": "flat"}
    assert {r.root: r.structure for r in inputs.structure(df).collect()} == {"run": "barcode_subdirs", "run/other": "flat", "flat": "flat", "deep/x": "flat"}


def test_budgets_are_exact(spark):
    rows = [(i, f"2024-01-01 00:00:{s}") for i, s in enumerate(["00.400", "59.800", "60.300", "60.400", "60.400001"])]
    rows = [(i, t.replace("00:00:60", "00:01:00")) for i, t in rows]
    df = spark.createDataFrame(rows, "id int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    assert sorted(r.id for r in inputs.within_budget(df, "ts", 1).collect()) == [0, 1, 2, 3]
    assert sorted(r.id for r in inputs.within_budget(df, "ts", 0.5, 0.5, F.lit("2024-01-01 00:00:00")).collect()) == [0, 1]
