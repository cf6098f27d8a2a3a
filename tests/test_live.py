"""Budgets, carried totals and metrics of live queries."""

import time

from pyspark.sql import functions as F

from fluvia.streaming import batches, live

SCHEMA = "id long, sample_id string, priority_score long"


def put(spark, path, ids):
    spark.createDataFrame([(i, "ab"[i % 2], i * 10) for i in ids], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def ids(found):
    return sorted(r.id for r in found.collect())


def test_stop_on_a_number_of_items(spark, tmp_path):
    src = f"{tmp_path}/in"
    for part in ([1, 2, 3], [4, 5, 6], [7, 8, 9]):
        put(spark, src, part)
    stream = batches.watch(spark, src, SCHEMA, files_per_batch=1)
    run = lambda most: live.admit(stream, f"{tmp_path}/out", f"{tmp_path}/ck", ["id"], most=most, seconds=60)
    assert ids(run(5)) == [1, 2, 3, 4, 5]
    assert ids(run(5)) == [1, 2, 3, 4, 5]  # a restart counts what was admitted before
    assert len(ids(run(7))) == 7


def test_stop_on_time_keeps_what_was_admitted(spark, tmp_path):
    src = f"{tmp_path}/in"
    put(spark, src, [1, 2])

    @F.udf("long")
    def slow(x):
        time.sleep(0.5)
        return x

    stream = batches.watch(spark, src, SCHEMA, files_per_batch=1).withColumn("id", slow("id"))
    live.admit(stream, f"{tmp_path}/warm", f"{tmp_path}/ck-warm", ["id"], most=2, seconds=60)
    for i in range(3, 60):
        put(spark, src, [i]) if i < 9 else None
    began = time.monotonic()
    found = ids(live.admit(stream, f"{tmp_path}/out", f"{tmp_path}/ck", ["id"], seconds=1.25))
    assert 1.25 <= time.monotonic() - began < 20 and 0 < len(found) <= 8 and {1, 2} & set(found)
    assert ids(live.admit(stream, f"{tmp_path}/out", f"{tmp_path}/ck", ["id"], seconds=120, idle=4)) == list(range(1, 9))  # the rest is read later


def test_totals_survive_a_restart(spark, tmp_path):
    src = f"{tmp_path}/in"
    totals = {"files": F.count("*"), "priority": F.sum("priority_score")}
    for part in ([1, 2], [3], [4, 5, 6]):
        put(spark, src, part)
        found = live.carry(batches.watch(spark, src, SCHEMA), totals, f"{tmp_path}/out", f"{tmp_path}/ck")
    assert [(r.batch_id, r.files, r.total_files, r.total_priority) for r in found.orderBy("batch_id").collect()] == [(0, 2, 2, 30), (1, 1, 3, 60), (2, 3, 6, 210)]


def test_metrics_and_empty_sources(spark, tmp_path):
    src = f"{tmp_path}/in"
    put(spark, src, [1, 2, 3])
    put(spark, src, [4])
    with live.Metrics(spark) as m:
        batches.store(live.observe(batches.watch(spark, src, SCHEMA, files_per_batch=1), "files", ["a", "b"]), f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
        batches.store(batches.watch(spark, src, SCHEMA, names="none*"), f"{tmp_path}/out2", f"{tmp_path}/ck2").awaitTermination()
    found = m.table("files", "files long, min_priority long, max_priority long, files_a long, files_b long").collect()
    assert sorted(tuple(r)[1:] for r in found if r.files) == sorted([(3, 10, 30, 1, 2), (1, 40, 40, 1, 0)])
    assert len(list(m.warnings())) == 1
