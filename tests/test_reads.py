"""Presets that act, cut ends, and figures of verdicts against plain versions."""

import random

from fluvia.operators import aggregates, reads, validation

READ = "sample_id string, read_id string, sequence string, quality string"


def test_a_preset_keeps_its_share(spark):
    rows = [("s", str(i), "A" * 2000, "I" * 2000) for i in range(10)] + [("s", "bad", "A" * 3000, "!" * 3000), ("s", "short", "A" * 900, "I" * 900)]
    df = spark.createDataFrame(rows, READ)
    kept = lambda name: sorted(r.read_id for r in reads.apply_preset(df, ["sample_id"], name).collect())
    assert kept("balanced") == [str(i) for i in range(9)]
    assert kept("strict") == [str(i) for i in range(8)]
    assert len(kept("legacy")) == 10


def cut(sequence, quality, least, window=4):
    w = min(window, len(quality))
    good = [i for i in range(len(quality) - w + 1) if w and sum(ord(c) - 33 for c in quality[i : i + w]) >= w * least]
    return (sequence[good[0] : good[-1] + w], quality[good[0] : good[-1] + w]) if good else ("", "")


def test_ends_are_cut_by_windows(spark):
    rng = random.Random(2)
    rows = [("s", str(i), "".join(rng.choices("ACGT", k=n)), "".join(rng.choices("!+5I", k=n))) for i, n in enumerate([0, 1, 2, 3, 4, 5, *(rng.randint(6, 60) for _ in range(80)), 30000])]
    df = spark.createDataFrame([*rows, ("s", "none", None, None)], READ)
    found = {r.read_id: (r.sequence, r.quality) for r in reads.cut_ends(df, 20).collect()}
    assert found.pop("none") == (None, None)
    assert found == {i: cut(s, q, 20) for _, i, s, q in rows}


def test_mapping_figures(spark):
    rows = [
        ("s", "a", 100, 90, 10, "short", 500, 0, 100, 60, 90.0),
        ("s", "a", 100, 0, 100, "short", 500, 50, 150, 60, 99.0),  # not the read's first row
        ("s", "b", 0, 0, 5, "first", 900, 120, 130, 20, 80.0),
        ("s", "c", 50, 0, 50, "again", 900, 400, 300, 60, 100.0),  # no interval
        ("s", "d", 50, 0, 50, "first", 900, 200, 950, 3, 100.0),  # a poor mapping
    ]
    df = spark.createDataFrame(rows, "sample_id string, qname string, qlen long, qstart long, qend long, tname string, tlen long, tstart long, tend long, mapq long, identity double")
    totals = spark.createDataFrame([("s", 4), ("t", 9)], "sample_id string, total_reads long")
    s, t = sorted(validation.mapping_stats(df, totals, ["sample_id"], ["tstart", "tend"]).collect())
    assert (s.hits, s.hit_rate, s.avg_identity, s.avg_coverage) == (3, 0.75, 90.0, 0.9)
    assert (s.covered, s.aligned, s.contig, s.contig_length) == (150, 210, "first", 900)
    assert (round(s.breadth, 6), round(s.depth, 6), round(s.avg_mapq, 6)) == (0.166667, 1.4, 46.666667)
    assert (t.hits, t.avg_coverage, t.contig, t.contig_length, t.breadth, t.status) == (0, 0.0, "unknown", 0, 0.0, "rejected")


def test_blast_figures_and_advice(spark):
    df = spark.createDataFrame([("s", "a", 95.0, 80.0, 1e-20, 1), ("s", "a", 99.0, 10.0, 1e-50, 2), ("s", "b", 91.0, 60.0, 1e-30, 3)], "sample_id string, qname string, identity double, qcovs double, evalue double, row_no int")
    totals = spark.createDataFrame([("s", 2), ("t", 3)], "sample_id string, total_reads long")
    s, t = sorted(validation.blast_stats(df, totals, ["sample_id"], ["row_no"]).collect())
    assert (s.hits, s.avg_identity, s.avg_coverage, s.min_evalue) == (2, 93.0, 0.7, 1e-30)
    assert (t.hits, t.min_evalue, t.status) == (0, 1.0, "rejected")
    tools = lambda *rows: sorted((r.tool or "", r.advice) for r in aggregates.advice(spark.createDataFrame(list(rows), "tool string, retention double, quality_delta double, quality_after double, q30 double")).collect())
    assert tools(("chopper", 0.1, 0.0, 13.0, 0.0)) == [("", "choose_by_aim"), ("", "monitor_resources"), ("chopper", "good_default")]
    assert tools(("fastp", 0.6, 0.0, 13.0, 9.0), ("chopper", 1.0, 1.0, None, 9.0))[:4] == [("", "choose_by_aim"), ("", "chopper_is_faster"), ("", "monitor_resources"), ("", "prefer_native_tools")]
