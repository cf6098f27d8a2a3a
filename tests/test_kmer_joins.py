"""k-mers are counted in their read, and nothing that grows with the reads is broadcast."""

from collections import Counter

from fluvia.operators import kmer


def test_counted_kmers(spark):
    rows = [("ACGTACGTNACGacgt",), ("AC",), ("",), (None,), ("ACGxACG",)]
    df = spark.createDataFrame(rows, "s string").select(kmer.kmers(kmer.F.col("s"), 3).alias("a"), kmer.counted_kmers(kmer.F.col("s"), 3).alias("b"))
    for r in df.collect():
        assert Counter(r.a or []) == {x.kmer: x.n for x in r.b} and len(r.b) == len(set(r.a or []))


def test_reads_are_not_broadcast(spark):
    reads = spark.createDataFrame([("r", "ACGTACGTAC")], "read_id string, sequence string")
    taxonomy = spark.createDataFrame([("1", None), ("2", "1")], "taxid string, parent string")
    table = spark.createDataFrame([("ACG", "2")], "kmer string, taxid string")
    found = kmer.classify(reads, table, taxonomy, 3)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin [read_id") == 2
    assert [tuple(r) for r in found.collect()] == [("r", "C", "2")]


def test_kmers_of_reads_are_not_broadcast_where_their_files_are_small(spark, monkeypatch):
    reads = spark.createDataFrame([("r", "ACGTACGTAC")], "read_id string, sequence string")
    table = spark.createDataFrame([(f"{i:09d}", "2") for i in range(1000)], "kmer string, taxid string")
    monkeypatch.setattr(kmer, "_best_paths", lambda reads, hits, *_: hits)
    plan = lambda: kmer.classify(reads, table, None, 9)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin [kmer" in plan() and "BuildLeft" not in plan()
    monkeypatch.setattr(kmer, "_FEW", 999)
    assert "SortMergeJoin [kmer" in plan() and "Broadcast" not in plan()


def test_minimizers_do_not_depend_on_the_slices_of_texts(spark, monkeypatch):
    m = kmer.Minimizers(6, 4, 0)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(["ACGTACGTTA", "", None, "AAAAAAAAA", "AAAAAAAAA", "CGNACGTTGCA"] * 3)], "i int, s string").coalesce(1)
    found = lambda: rows.select("i", kmer.minimizers(kmer.F.col("s"), m)).collect()
    whole = found()
    for n in (1, 12):
        monkeypatch.setattr(kmer, "_LETTERS", n)
        assert found() == whole


def test_minimizers_of_reads_are_not_broadcast_where_their_files_are_small(spark, monkeypatch):
    reads = spark.createDataFrame([("r", "ACGTACGTAC")], "read_id string, sequence string")
    table = spark.createDataFrame([(i, "2") for i in range(1000)], "minimizer long, taxid string")
    monkeypatch.setattr(kmer, "_best_paths", lambda reads, hits, *_: hits)
    plan = lambda: kmer.classify_minimizers(reads, table, None, kmer.Minimizers(6, 4, 0))._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin [minimizer" in plan() and "BuildLeft" not in plan()
    monkeypatch.setattr(kmer, "_FEW", 999)
    assert "SortMergeJoin [minimizer" in plan() and "Broadcast" not in plan()
