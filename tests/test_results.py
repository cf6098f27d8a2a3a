"""Result bodies, session figures, coverage and QC records on small tables."""

import json

from pyspark.sql import functions as F

from fluvia.operators import aggregates, windows
from fluvia.sources import bodies, committed, formats


def texts(lines):
    out = {}
    for r in sorted(lines.collect(), key=lambda r: (r.file, r.row_no)):
        out[r.file] = out.get(r.file, "") + r.value
    return out


def test_assembly_bodies_are_json_with_what_is_known(spark):
    contigs = spark.createDataFrame([("a", 0, "c1", 600, 30.5, True, 1.0), ("a", 1, "c2", 300, 3.0, False, 0.0), ("a", 2, "c3", 100, 1.0, False, None), ("b/x", 5, "d", 9, 2.0, False, None)], "sample_id string, place long, name string, length long, coverage double, circular boolean, repeat double")
    bases = spark.createDataFrame([("a", "c1", 1, 3), ("a", "c2", 2, 3), ("a", "c3", 0, 0), ("a", "other", 5, 5), ("a", "c2", 1, 3)], "sample_id string, name string, gc long, acgt long")
    got = texts(bodies.assembly_lines(contigs, bases))
    a = json.loads(got["a.assembly.json"])
    assert a["summary"] == {"total_contigs": 3, "total_length": 1000, "largest_contig": 600, "n50": 600, "l50": 1, "circular_contigs": 1, "gc_content": 0.642857}
    assert a["contigs"] == [
        {"name": "c1", "length": 600, "coverage": 30.5, "is_circular": True, "repeat_fraction": 1.0, "gc_content": 0.333333},
        {"name": "c2", "length": 300, "coverage": 3.0, "is_circular": False, "gc_content": 0.666667},
        {"name": "c3", "length": 100, "coverage": 1.0, "is_circular": False},
    ]
    b = json.loads(got["b_x.assembly.json"])
    assert b["sample_id"] == "b/x" and "gc_content" not in b["summary"] and len(b["contigs"]) == 1
    assert texts(bodies.assembly_lines(contigs.limit(0), bases)) == {}


def test_qc_bodies_of_both_formats(spark, tmp_path):
    seqkit = spark.createDataFrame([("s", 12, 600, 50.0, 0.9125, 0.8, 0.412, 51), ("t", 0, 0, 0.0, 0.0, 0.0, 0.0, None)], "sample_id string, num_seqs long, sum_len long, avg_len double, q20 double, q30 double, gc double, n50 long")
    got = {k: json.loads(v) for k, v in texts(bodies.qc_lines(bodies.seqkit_qc(seqkit))).items()}
    assert got["s.qc.json"] == {"format_version": "1.0.0", "sample_id": "s", "before_filtering": None, "after_filtering": {"total_reads": 12, "total_bases": 600, "q20_rate": 0.9125, "q30_rate": 0.8, "gc_content": 0.412, "mean_length": 50.0, "n50": 51}}
    assert "n50" not in got["t.qc.json"]["after_filtering"]
    (tmp_path / "f.json").write_text(json.dumps({"summary": {"before_filtering": {"total_reads": 10, "q20_rate": 0.9}}, "filtering_result": {"passed_filter_reads": 8, "too_many_N_reads": 2}}))
    fastp = formats.fastp(spark, str(tmp_path / "f.json")).withColumn("sample_id", F.lit("f"))
    body = json.loads(texts(bodies.qc_lines(bodies.fastp_qc(fastp)))["f.qc.json"])
    assert body["before_filtering"]["total_reads"] == 10 and body["after_filtering"]["total_reads"] == 0
    assert body["filtering_result"] == {"passed_filter_reads": 8, "low_quality_reads": 0, "too_short_reads": 0, "too_long_reads": 0, "too_many_n_reads": 2, "adapter_trimmed_reads": 0}


def test_sidecars_say_how_a_result_was_made(spark):
    rows = spark.createDataFrame([("s", ["a.txt"], 0), ("t", [], None)], "sample_id string, source_files array<string>, batch long")
    got = texts(bodies.sidecar_lines(rows, "taxonomy", "tool", "1.2", F.lit("2024-01-02 03:04:05").cast("timestamp"), ".meta.json", "realtime", is_cumulative=F.lit(False), batch_id=F.col("batch")))
    assert json.loads(got["s.meta.json"]) == {"contract_version": "1.0.0", "category": "taxonomy", "tool": {"name": "tool", "version": "1.2"}, "sample_id": "s", "timestamp": "2024-01-02T03:04:05Z", "format_version": "1.0.0", "mode": "realtime", "source_files": ["a.txt"], "is_cumulative": False, "batch_id": 0}
    assert "batch_id" not in json.loads(got["t.meta.json"])


def test_fixed_places(spark):
    rows = spark.createDataFrame([(0.0,), (0.5,), (99.995,), (12.34567,), (1234567.0,), (None,)], "x double")
    got = [r.v for r in rows.select(bodies.fixed_text(F.col("x"), 4).alias("v")).collect()]
    assert got == ["0.0000", "0.5000", "99.9950", "12.3457", "1234567.0000", None]
    assert [r.v for r in rows.select(bodies.fixed_text(F.col("x"), 0).alias("v")).limit(2).collect()] == ["0", "1"]


def test_reads_of_a_large_sample_go_to_many_files(spark, tmp_path):
    rows = [("big", f"r{i}", "ACGT", "!@+I") for i in range(500)] + [(None, "n", "", ""), ("a b", "dup", "A", "!"), ("a b", "dup", "A", "!")]
    committed.write(bodies.fastq_lines(spark.createDataFrame(rows, "sample_id string, read_id string, sequence string, quality string"), 50), str(tmp_path))
    assert len(list((tmp_path / "big").iterdir())) == 10
    long = spark.createDataFrame([("one", f"r{i}", "A" * 100, "!" * 100) for i in range(200)], "sample_id string, read_id string, sequence string, quality string")
    assert bodies.fastq_lines(long, file_letters=4000).select("file").distinct().count() == 10
    found = sorted((r.path.split("/")[-2], r.read_id, r.sequence, r.quality) for r in formats.fastq(spark, str(tmp_path)).collect())
    assert found == sorted(({"a b": "a_b", None: "none"}.get(s, s), i, q, p) for s, i, q, p in rows)


def test_session_figures_start_with_the_first_batch(spark):
    cols = "batch_id long, at_ms long, files long, total_bytes long, total_mb double, reads long, compressed long, compressed_ratio double, avg_priority double, large_ratio double"
    rows = [(7, 1_000, 4, 400, 0.25, 10, 1, 0.25, 5.0, 0.0), (9, 3_500, 6, 600, 0.5, 11, 2, 0.5, 6.0, 0.1), (8, 1_000, 1, 100, 0.01, 0, 0, 0.0, 7.0, 0.2)]
    snaps = spark.createDataFrame(rows, cols)
    got = [r.asDict() for r in aggregates.session_report(snaps).orderBy("batch_id").collect()]
    assert [(r["duration_seconds"], r["files_per_second"], r["batches_per_minute"]) for r in got] == [(0.0, 0.0, 0.0), (0.0, 0.0, 0.0), (2.5, 4.4, 72.0)]
    last = got[-1]
    assert (last["total_bytes"], last["total_mb"], last["mb_per_second"], last["reads_per_second"], last["files_per_batch"], last["reads_per_batch"], last["mb_per_file"], last["total_compressed"]) == (1100, 0.76, 0.3, 8.0, 3.67, 7.0, 0.07, 3)
    trends = [r.asDict() for r in aggregates.session_trends(snaps, 2).orderBy("batch_id").collect()]
    assert [t["batch_file_counts"] for t in trends] == [[4], [4, 1], [1, 6]] and trends[-1]["large_file_ratios"] == [0.2, 0.1]
    assert aggregates.session_report(snaps.limit(0)).count() == 0


def test_coverage_totals(spark):
    rows = spark.createDataFrame([("m", "P0", True), ("m", "P1", False), ("w", "P0", True), ("w", "P2", False), (None, "P1", False), ("w", None, True)], "component string, priority string, hit boolean")
    got = {(r.component, r.priority): (r.tests, r.covered, r.percent) for r in aggregates.coverage(rows).collect()}
    assert got[("all", "P0+P1")] == (4, 2, 50.0) and got[("all", "all")] == (6, 3, 50.0) and got[("w", "all")] == (3, 2, 2 / 3 * 100)
    assert ("w", None) not in got and got[("m", "P1")] == (1, 0, 0.0)


def test_records_lack_no_part_unless_it_is_optional(spark):
    reads = spark.createDataFrame([("a", 1), ("b", 2)], "sample_id string, n int")
    side = spark.createDataFrame([("a", 5), ("c", 6)], "sample_id string, x int")
    strict = aggregates.qc_records("t", "k", reads, side).collect()
    assert [(r.sample_id, r.reads.n, r.side.x, r.stats) for r in strict] == [("a", 1, 5, None)]
    loose = {r.sample_id: (r.reads, r.side) for r in aggregates.qc_records("t", "k", reads, side, optional=True).collect()}
    assert set(loose) == {"a", "b", "c"} and loose["b"][1] is None and loose["c"][0] is None


def test_sequences_in_lines(spark):
    rows = spark.createDataFrame([("A" * n,) for n in (0, 1, 69, 70, 71, 140, 141)] + [(None,)], "s string")
    got = [r.v for r in rows.select(windows.wrapped(F.col("s")).alias("v")).collect()]
    assert [None if g is None else [len(x) for x in g.split("\n")] for g in got] == [[0], [1], [69], [70], [70, 1], [70, 70], [70, 70, 1], None]
