"""Record readers whose splits end at records, and the sink that commits whole files."""

import gzip
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fluvia.sources import committed, records


def made(n, seed=1):
    """Reads of 0 to 40 letters whose qualities often begin with @ or +."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        k = r.choice([0, 1, 2, 7, 40])
        out.append((f"r{i}", "".join(r.choices("ACGTN", k=k)), "".join(r.choices("@+!I~", k=k))))
    return out


def text(rows, end="\n"):
    return "".join(f"@{a} x{end}{s}{end}+{end}{q}{end}" for a, s, q in rows)


@pytest.mark.parametrize("size", [1, 3, 17, 1000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_every_split_size_finds_the_same_reads(tmp_path, size, end):
    rows = made(60)
    at = tmp_path / "a.fastq"
    at.write_bytes(text(rows, end).encode())
    found = [x for s in records.RecordReader({"path": str(at), "splitbytes": size}, [], None).partitions() for x in records.fastq_records(s)]
    assert found == [tuple(v.encode() for v in row) for row in rows]


@pytest.mark.parametrize("size", [1, 5, 64, 1 << 20])
def test_every_split_size_finds_the_same_contigs(tmp_path, size):
    at = tmp_path / "a.fa"
    at.write_text("; note\n>c1 first\nACGT\nAC GT\n\n>c2\n>c3\tx\nGG\n>\nTT")
    found = [x for s in records.RecordReader({"path": str(at), "splitbytes": size}, [], None).partitions() for x in records.fasta_records(s)]
    assert found == [(b"c1", b"ACGTACGT"), (b"c2", b""), (b"c3", b"GG"), (b"", b"TT")]


@pytest.mark.parametrize("size", [1, 4, 1 << 20])
def test_broken_records_cost_no_others(tmp_path, size):
    at = tmp_path / "a.fastq"
    at.write_text("\n@cut\nAC\n@r1\nA\n+\n!\n\nnoise\n@long\nACG\n+\n!\n@r2\nC\n+r2\n@\n@last\nA\n+\n")
    found = [x[0] for s in records.RecordReader({"path": str(at), "splitbytes": size}, [], None).partitions() for x in records.fastq_records(s)]
    assert found == [b"r1", b"r2"]


def test_plain_and_packed_files_in_one_folder_without_a_shuffle(spark, tmp_path):
    rows = made(300)
    (tmp_path / "sub").mkdir()
    (tmp_path / "plain.fastq.gz").write_text(text(rows[:100]))  # the name says gzip, the bytes do not
    # Two members, as files that were joined have them.
    (tmp_path / "sub" / "packed.fastq").write_bytes(gzip.compress(text(rows[100:150]).encode()) + gzip.compress(text(rows[150:200]).encode()))
    (tmp_path / "more.fq").write_text(text(rows[200:]))
    (tmp_path / ".hidden.fastq").write_text(text([("no", "A", "!")]))
    (tmp_path / "empty.fastq").write_text("")
    found = records.read(spark, "fastq", str(tmp_path), split_bytes=500)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and found.rdd.getNumPartitions() > 10
    assert sorted((r.read_id, r.sequence, r.quality) for r in found.collect()) == sorted(rows)
    named = records.read(spark, "fastq", f"{tmp_path}/more.fq,file://{tmp_path}/sub", names="*.f*q")
    assert named.count() == 200
    assert records.read(spark, "fastq", str(tmp_path), names="*.none").count() == 0
    assert records.read(spark, "fastq", f"{tmp_path}/*.f*q").count() == 100 and records.read(spark, "fastq", f"{tmp_path}/s?b/*").count() == 100
    with pytest.raises(PySparkException):
        records.read(spark, "fastq", f"{tmp_path}/gone").count()


def lines(spark, rows):
    return spark.createDataFrame(rows, "file string, row_no long, value string")


def test_files_are_whole_and_in_order(spark, tmp_path):
    rows = [(f"s{k}/r.txt", i, f"line {i}") for k in range(9) for i in range(40)] + [("void.txt", 0, None)]
    (tmp_path / "old.txt").write_text("stays")
    committed.write(lines(spark, rows[::-1]).repartition(7), str(tmp_path))
    for k in range(9):
        assert (tmp_path / f"s{k}" / "r.txt").read_text() == "".join(f"line {i}\n" for i in range(40))
    assert (tmp_path / "void.txt").read_text() == "" and (tmp_path / "old.txt").read_text() == "stays"
    committed.write(lines(spark, [("s1/r.txt", 0, "new")]), f"file://{tmp_path}")
    assert (tmp_path / "s1" / "r.txt").read_text() == "new\n"
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(["old.txt", "void.txt", *(f"s{k}" for k in range(9))])


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    at = tmp_path / "out"
    rows = lines(spark, [(f"f{i}", 0, str(i)) for i in range(20)])
    bad = rows.withColumn("value", F.when(F.col("file") == "f13", F.raise_error(F.lit("stop"))).otherwise(F.col("value")))
    with pytest.raises(PySparkException):
        committed.write(bad, str(at))
    assert not at.exists() or not list(at.iterdir())
    for name in ("../x", "", "_job", "a//b"):
        with pytest.raises(PySparkException):
            committed.write(lines(spark, [(name, 0, "v")]), str(at))
    assert not at.exists() or not list(at.iterdir())


def test_lines_of_one_file_in_two_tasks_are_refused(spark, tmp_path):
    committed.register(spark)
    rows = spark.createDataFrame([("f", "a"), ("f", "b")], "file string, value string").repartition(2)
    with pytest.raises(PySparkException):
        rows.write.format("committed_texts").mode("append").save(str(tmp_path / "o"))
    assert not list((tmp_path / "o").iterdir())


def test_an_empty_table_writes_no_file(spark, tmp_path):
    committed.write(lines(spark, []), str(tmp_path / "o"))
    assert not (tmp_path / "o").exists() or not list((tmp_path / "o").iterdir())
