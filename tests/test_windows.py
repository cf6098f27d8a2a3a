"""Merged intervals and verdicts by stage against plain versions."""

import random

from pyspark.sql import functions as F

from fluvia.operators import validation, windows


def islands(spans):
    out = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return sorted(map(tuple, out))


def test_islands_across_ranges(spark):
    rng = random.Random(4)
    spans = {k: [(s, s + rng.randint(1, 40)) for s in (rng.randint(0, 3000) for _ in range(60))] for k in "ab"}
    spans["a"] += [(10, 400), (64, 128), (128, 192)]
    df = spark.createDataFrame([(k, lo, hi) for k, v in spans.items() for lo, hi in v], "k string, tstart long, tend long")
    for width in (64, 1 << 14):
        found = windows.interval_islands(df, ["k"], width=width).collect()
        for k, v in spans.items():
            assert sorted((r.lo, r.hi) for r in found if r.k == k) == islands(v)
    assert windows.interval_islands(df.limit(0), ["k"]).count() == 0


def test_verdicts_by_stage_where_hits_change(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), f"q{rng.randint(0, 30)}", rng.randint(0, 4), rng.randint(0, 99), float(rng.randint(70, 100)), rng.randint(0, 20)) for _ in range(300)] + [("c", "q", 2, 1, 99.0, 0)]
    df = spark.createDataFrame(rows, "taxid string, qname string, stage long, tstart long, identity double, mapq long")
    found = {(r.taxid, r.stage): r for r in validation.verdicts_by_stage(df, F.col("mapq") >= 10, ["taxid"], "stage", ["tstart", "identity"]).collect()}
    assert set(found) == {(t, s) for t, _, s, *_ in rows}
    for (taxid, stage), r in found.items():
        seen = [x for x in rows if x[0] == taxid and x[2] <= stage]
        best = {}
        for x in sorted((x for x in seen if x[5] >= 10), key=lambda x: (x[3], x[4])):
            best.setdefault(x[1], x[4])
        mean = sum(best.values()) / len(best) if best else 0.0
        assert (r.total_reads, r.hits) == (len(seen), len(best)) and abs(r.avg_identity - mean) < 1e-9
