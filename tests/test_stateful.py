"""Streams with keyed state against plain versions, over restarts, late and repeated batches."""

from fluvia.streaming import batches, stateful

ITEMS = "stream string, ts timestamp, item long"
TAXA = "sample_id string, batch_id long, taxid string, reads long, cumul long, rank string, name string, parent string"
RESULTS = "sample_id string, taxid string, batch_id long, arrival long, total long, hits long"


def put(spark, path, rows, schema):
    text = schema.replace("timestamp", "string")
    df = spark.createDataFrame(rows, text)
    if "timestamp" in schema:
        df = df.withColumn("ts", df.ts.cast("timestamp"))
    df.coalesce(1).write.mode("append").parquet(path)


def at(seconds):
    return f"2024-01-01 00:{seconds // 60:02d}:{seconds % 60:02d}"


def plain(items, n, seconds):
    """{number: items} of one stream (second, item), in order."""
    out, buffer, start, tick = [], [], None, 0
    for s, item in items:
        start = s if start is None else start
        now = (s - start) // seconds if seconds else 0
        if now > tick and buffer:
            out.append(buffer)
            buffer = []
        tick = max(tick, now)
        buffer.append(item)
        if len(buffer) >= n:
            out.append(buffer)
            buffer = []
    return out + [buffer] * bool(buffer)


def told(found):
    out = {}
    for r in found.collect():
        out.setdefault((r.stream, r.number), []).append((r.at, r.item))
    return {k: [i for _, i in sorted(x)] for k, x in out.items()}


def test_batches_by_count_or_tick_over_a_restart(spark, tmp_path):
    a = [(3, 1), (4, 2), (5, 3), (20, 4), (33, 5), (34, 6), (35, 7), (36, 8), (63, 9), (200, 10), (201, 11)]
    b = [(7, 50), (500, 51)]
    for seconds in (30, None):
        src, to = f"{tmp_path}/in-{seconds}", f"{tmp_path}/out-{seconds}"
        for part in (a[:2], a[2:6] + b[:1], a[6:], b[1:]):
            put(spark, src, [("b" if i >= 50 else "a", at(s), i) for s, i in part], ITEMS)
            stream = batches.watch(spark, src, ITEMS)
            found = told(stateful.batched(stream, 3, seconds, to))  # each time from the checkpoint
        expected = {(k, i): x for k, rows in (("a", a), ("b", b)) for i, x in enumerate(plain(rows, 3, seconds))}
        assert found == expected


def test_a_quiet_stream_is_given_out_when_time_passes(spark, tmp_path):
    src, to = f"{tmp_path}/in", f"{tmp_path}/out"
    put(spark, src, [("a", at(1), 1), ("b", at(1), 2)], ITEMS)
    put(spark, src, [("b", at(600), 3)], ITEMS)
    made = stateful.count_or_tick(batches.watch(spark, src, ITEMS, files_per_batch=1), 5, 30, late="1 second")
    stateful.run(made, f"{to}/table", f"{to}/checkpoint")
    assert ("a", 1) in {(r.stream, r.item) for r in stateful.written(spark, f"{to}/table", made.schema).collect()}
    assert told(stateful.remainder(spark, f"{to}/checkpoint")) == {("b", 1): [3]}


def test_an_empty_stream(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [("a", at(1), 1)], ITEMS)
    empty = batches.watch(spark, f"{tmp_path}/in", ITEMS, names="none*")
    assert stateful.batched(empty, 3, 30, f"{tmp_path}/out").count() == 0


def test_running_taxa(spark, tmp_path):
    src, to = f"{tmp_path}/in", f"{tmp_path}/out"
    tables = [
        [("s", 0, "1", 1, 5, "R", "root", None), ("s", 0, "9", 2, 2, "S", "x", None)],
        [("s", 1, "9", 1, 1, "G", "other", "1"), ("t", 0, "1", 7, 7, "R", "root", None)],
        [("s", 2, "9", 1, 1, "S", "x", "7"), ("s", 3, "1", 1, 1, "R", "root", None)],
        [("s", 4, "2", 3, 3, "D", "d", "1")],
    ]
    for rows in tables:
        put(spark, src, rows, TAXA)
        found = stateful.reported(batches.watch(spark, src, TAXA), 2, to).collect()
    own = {}
    for r in found:
        own.setdefault((r.sample_id, r.batches), {})[r.taxid] = (r.reads, r.cumul, r["rank"], r.name, r.parent)
    root = lambda n, c: (n, c, "R", "root", None)
    assert own == {
        ("s", 1): {"1": root(1, 5), "9": (2, 2, "S", "x", None)},
        ("s", 2): {"1": root(1, 5), "9": (3, 3, "S", "x", "1")},
        ("s", 4): {"1": root(2, 6), "9": (4, 4, "S", "x", "1")},
        ("s", 5): {"1": root(2, 6), "9": (4, 4, "S", "x", "1"), "2": (3, 3, "D", "d", "1")},
        ("t", 1): {"1": root(7, 7)},
    }


def test_results_by_batch_are_replaced_and_keep_their_place(spark, tmp_path):
    src, to = f"{tmp_path}/in", f"{tmp_path}/out"
    put(spark, src, [("s", "9", 2, 0, 10, 1), ("s", "9", 0, 1, 5, 5), ("t", "9", 0, 0, 1, 1)], RESULTS)
    stateful.accumulated(batches.watch(spark, src, RESULTS), to)
    put(spark, src, [("s", "9", 2, 5, 20, 2), ("s", "9", 2, 4, 99, 9), ("s", "9", 1, 6, 1, 0)], RESULTS)  # a replay and a late batch
    found = {(r.sample_id, r.taxid): (r.batches, r.total, r.hits) for r in stateful.accumulated(batches.watch(spark, src, RESULTS), to).collect()}
    assert found == {("s", "9"): (["2", "0", "1"], 26, 7), ("t", "9"): (["0"], 1, 1)}
