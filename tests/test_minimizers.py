"""Minimizers against a plain search, tables in buckets, and verdicts of new batches only."""

import random

import pytest
from pyspark.sql import functions as F

from fluvia.operators import kmer


def plain(text, m):
    """Each k-mer's minimizer, letter by letter."""
    def code(word):
        word = word.upper()
        own = sum("ACGT".index(c) << 2 * (m.l - 1 - i) for i, c in enumerate(word))
        back = sum((3 - "ACGT".index(c)) << 2 * i for i, c in enumerate(word))
        return (min(own, back) & m.mask) ^ (m.toggle & m.mask)

    out = []
    for i in range(len(text) - m.k + 1):
        k = text[i : i + m.k]
        out.append(None if set(k.upper()) - set("ACGT") else min(code(k[j : j + m.l]) for j in range(m.k - m.l + 1)))
    return out


@pytest.mark.parametrize("m", [kmer.Minimizers(), kmer.Minimizers(9, 5, 1), kmer.Minimizers(6, 6, 0), kmer.Minimizers(20, 5, 2), kmer.Minimizers(3, 1, 0)])
def test_minimizers_equal_a_plain_search(spark, m):
    rng = random.Random(7)
    texts = ["".join(rng.choices("ACGTacgtN", [9] * 8 + [1], k=n)) for n in (0, 1, m.k - 1, m.k, m.k + 1, 80, 300)] + ["A" * 90, "é" * 40, None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, sequence string")
    got = {r.i: sorted(map(tuple, r.x)) for r in rows.select("i", kmer.minimizers(F.col("sequence"), m).alias("x")).collect()}
    for i, text in enumerate(texts):
        codes, groups = plain(text or "", m), {}
        for c, before in zip(codes, [None, *codes]):
            if c is not None:
                n, g = groups.get(c, (0, 0))
                groups[c] = n + 1, g + (c != before)
        assert got[i] == sorted((c, n, g) for c, (n, g) in groups.items())


def test_a_read_and_its_reverse_complement_agree():
    m, rng = kmer.Minimizers(15, 9, 0), random.Random(1)
    s = "".join(rng.choices("ACGT", k=200))
    back = s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert list(m.codes(s)[0]) == list(m.codes(back)[0][::-1])


def test_sizes_that_cannot_be():
    for bad in ((5, 6, 0), (40, 32, 0), (9, 5, 3), (9, 0, 0)):
        with pytest.raises(ValueError):
            kmer.Minimizers(*bad)


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(3)
    shared = "".join(rng.choices("ACGT", k=100))
    own = {t: "".join(rng.choices("ACGT", k=400)) for t in ("20", "21", "30")}
    genomes = spark.createDataFrame([(t, g + (shared if t != "30" else "")) for t, g in own.items()] + [("30", None), ("30", "")], "taxid string, sequence string")
    tax = spark.createDataFrame([("1", None), ("2", "1"), ("3", "1"), ("20", "2"), ("21", "2"), ("30", "3")], "taxid string, parent string")
    reads = [(1, "a", own["20"][50:200]), (1, "b", own["21"][:150]), (2, "a", shared), (2, "c", own["30"][100:260]), (3, "d", "".join(rng.choices("ACGT", k=150))), (3, "e", "ACGT"), (3, "f", None)]
    return genomes, tax, spark.createDataFrame(reads, "batch_id long, read_id string, sequence string")


WANTED = {(1, "a", "C", "20"), (1, "b", "C", "21"), (2, "a", "C", "2"), (2, "c", "C", "30"), (3, "d", "U", "0"), (3, "e", "U", "0"), (3, "f", "U", "0")}


def test_pieces_do_not_change_the_table(spark, world):
    genomes, tax, _ = world
    m = kmer.Minimizers(21, 15, 3)
    rows = [sorted(map(tuple, kmer.build_minimizer_table(genomes, tax, m, piece).collect())) for piece in (1 << 16, 37)]
    assert rows[0] == rows[1] and {t for _, t in rows[0]} == {"20", "21", "30", "2"}


def test_a_stored_table_is_not_shuffled(spark, world):
    genomes, tax, reads = world
    m = kmer.Minimizers(21, 15, 3)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold") if spark.conf.get(k, None)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        table = kmer.store_table(kmer.build_minimizer_table(genomes, tax, m), "minimizer_table_test", 4)
        x = reads.select(F.explode(kmer.minimizers(F.col("sequence"), m)).alias("x")).select("x.minimizer")
        plan = x.join(table, "minimizer")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    finally:
        spark.sql("DROP TABLE IF EXISTS minimizer_table_test")
        for k in ("spark.sql.autoBroadcastJoinThreshold",):
            spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)


def test_only_new_batches_are_classified(spark, world, tmp_path):
    genomes, tax, reads = world
    m = kmer.Minimizers(21, 15, 3)
    table = kmer.build_minimizer_table(genomes, tax, m).cache()
    source, store = str(tmp_path / "reads"), str(tmp_path / "verdicts")
    seen = []

    def classified(x):
        seen.append(x._jdf.queryExecution().executedPlan().toString())
        return kmer.classify_minimizers(x, table, tax, m, 0.1, 2)

    reads.filter("batch_id < 3").write.partitionBy("batch_id").parquet(source)
    assert kmer.classify_new(spark.read.parquet(source), store, classified) == [1, 2]
    assert kmer.classify_new(spark.read.parquet(source), store, classified) == []
    reads.filter("batch_id = 3").write.mode("append").partitionBy("batch_id").parquet(source)
    assert kmer.classify_new(spark.read.parquet(source), store, classified) == [3]
    assert "PartitionFilters: [isnotnull(batch_id" in seen[1] and "= 3)" in seen[1]
    read = lambda: {tuple(r) for r in kmer.stored_verdicts(spark, store).select("batch_id", "read_id", "status", "taxid").collect()}
    assert read() == WANTED
    assert kmer.classify_new(spark.read.parquet(source), store, classified, redo=(1,)) == [1]
    assert read() == WANTED

    def fails(x):
        return classified(x).withColumn("status", F.raise_error(F.lit("lost")).cast("string"))

    with pytest.raises(Exception, match="lost"):
        kmer.classify_new(spark.read.parquet(source), store, fails, redo=(1, 2))
    assert read() == WANTED
    empty = kmer.classify_new(spark.createDataFrame([], reads.schema), str(tmp_path / "none"), classified)
    assert empty == []
