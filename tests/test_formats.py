"""Format readers on small files."""

import json

import pytest
from pyspark.errors import PySparkException

from fluvia.sources import formats


def write(path, text):
    path.write_text(text)
    return str(path)


def test_kreport_skips_odd_rows(spark, tmp_path):
    p = write(tmp_path / "r.txt", "# note\n20.0\t2\t2\tU\t0\tunclassified\n80.0\t8\t1\tR\t1\troot\n\n70.0\t7\t7\tS\t562\t    Escherichia coli\nshort\t1\n1.0\tx\t1\tS\t9\tbad\n")
    found = formats.kreport(formats.lines(spark, p)).orderBy("line_no").collect()
    assert [(r.taxid, r.cumul, r.depth, r.name) for r in found] == [("0", 2, 0, "unclassified"), ("1", 8, 0, "root"), ("562", 7, 2, "Escherichia coli")]
    with pytest.raises(PySparkException):
        formats.kreport_strict(formats.lines(spark, p)).collect()


def test_hits_and_alignments(spark, tmp_path):
    b = write(tmp_path / "b.tsv", "q1\ts1\t98.5\t100\t1\t0\t1\t100\t5\t104\t1e-30\t180\n#c\nq2\ts1\t90\t50\t5\t0\t1\t50\t1\t50\t0.1\t40\t60\t500\t83\n")
    found = {r.qseqid: r for r in formats.blast(formats.rows(spark, b)).collect()}
    assert found["q1"].qcovs == -1 and found["q1"].evalue == 1e-30 and found["q2"].qcovs == 83
    p = write(tmp_path / "a.paf", "q\t100\t0\t90\t+\tt\t1000\t10\t100\t80\t90\t60\ttp:A:P\tdv:f:0.02\nq2\t100\t0\t90\t-\tt\t1000\t10\t100\t81\t90\t60\nshort\t1\n")
    found = {r.qname: r for r in formats.paf(formats.rows(spark, p)).collect()}
    assert found["q"].identity == pytest.approx(98) and found["q"].tags == ["tp:A:P", "dv:f:0.02"] and found["q2"].identity == pytest.approx(90)


def test_assignments_and_logs(spark, tmp_path):
    a = write(tmp_path / "k.txt", "C\tr1\t562\t100\t562:66\nU\tr2\t0\t50\t0:16\nbroken\n")
    assert sorted((r.status, r.read_id, r.taxid, r.length) for r in formats.assignments(formats.rows(spark, a)).collect()) == [("C", "r1", "562", 100), ("U", "r2", "0", 50)]
    log = write(tmp_path / "f.log", "x\n10 reads in input\n  7 reads in output\n")
    assert [(r.reads_in, r.reads_out) for r in formats.filter_log(formats.rows(spark, log)).collect()] == [(10, 7)]


def test_statistics(spark, tmp_path):
    s = write(tmp_path / "s.tsv", "file\tnum_seqs\tsum_len\tmin_len\tavg_len\tmax_len\tN50\tQ20(%)\tQ30(%)\tAvgQual\tGC(%)\na\t1,200\t600,000\t10\t500.0\t900\t510\t91.25\t80\t15.5\t41.2\nb\t1\t1\t1\t1\t1\t1\t1\t1\t1\t1\n")
    r = formats.seqkit_stats(spark, s).first()
    assert (r.num_seqs, r.sum_len, r.q20, r.gc, r.n50) == (1200, 600000, 0.9125, 0.412, 510)
    f = write(tmp_path / "f.json", json.dumps({"summary": {"before_filtering": {"total_reads": 10, "q20_rate": 0.9}}, "filtering_result": {"passed_filter_reads": 8}}))
    r = formats.fastp(spark, f).first()
    assert (r.before_total_reads, r.before_q20_rate, r.after_total_reads, r.passed_filter_reads, r.too_short_reads) == (10, 0.9, 0, 8, 0)
    i = write(tmp_path / "i.txt", "#seq_name\tlength\tcov.\tcirc.\trepeat\nc1\t5000\t30\tY\tN\nc2\t100\t3\tN\tY\nbad\t1\n")
    assert [(r.name, r.circular, r.repeat) for r in formats.flye_info(formats.lines(spark, i)).orderBy("name").collect()] == [("c1", True, None), ("c2", False, 1.0)]


def test_sequences(spark, tmp_path):
    a = write(tmp_path / "a.fa", ">c1 first\nACGT\nAC\n>c2\nGG\n")
    assert sorted((r.name, r.sequence) for r in formats.fasta(spark, a).collect()) == [("c1", "ACGTAC"), ("c2", "GG")]
    q = write(tmp_path / "q.fastq", "@r1 x\nACG\n+\n!!!\n@r2\nA\n+\n@\n@cut\nAC\n")
    assert sorted((r.read_id, r.sequence, r.quality) for r in formats.fastq(spark, q).collect()) == [("r1", "ACG", "!!!"), ("r2", "A", "@")]


def test_large_fastq_is_read_in_splits(spark, tmp_path):
    made = [(f"r{i}", "ACGT" * (i % 9 + 1), "@+!I" * (i % 9 + 1)) for i in range(2000)]
    q = write(tmp_path / "q.fastq", "".join(f"@{a} x\n{s}\n+\n{c}\n" for a, s, c in made))
    write(tmp_path / "p.fastq", "@other\nA\n+\n!\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        found = formats.fastq(spark, str(tmp_path))
        assert formats.numbered(spark, q).rdd.getNumPartitions() > 1
        assert sorted((r.read_id, r.sequence, r.quality) for r in found.collect()) == sorted([*made, ("other", "A", "!")])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_maps_and_sheets(spark, tmp_path):
    g = write(tmp_path / "g.json", '{"562": "/a/x.fa", "9": "y.fa"}')
    found = {r.taxid: r.genome for r in formats.genome_map(spark, g).collect()}
    assert found["562"] == "/a/x.fa" and found["9"].endswith(f"{tmp_path}/y.fa")
    with pytest.raises(PySparkException):
        formats.genome_map(spark, write(tmp_path / "h.json", '{"562": {"path": "x"}}')).collect()
    assert [(r.taxid, r.name) for r in formats.taxon_names(spark, write(tmp_path / "n.json", '{"1": "root", "2": " "}')).collect()] == [("1", "root")]
    s = write(tmp_path / "s.csv", "sample,fastq,barcode\na,x.fastq.gz, barcode01\nb,y.fq,\na,z.fastq,barcode02\n")
    assert sorted((r.sample_id, r.barcode, r.files) for r in formats.samplesheet(spark, s).collect()) == [("a", "barcode01", ["x.fastq.gz", "z.fastq"]), ("b", None, ["y.fq"])]
    with pytest.raises(PySparkException):
        formats.samplesheet(spark, write(tmp_path / "t.csv", "sample,fastq,barcode\na b,x.fastq,\n")).collect()
