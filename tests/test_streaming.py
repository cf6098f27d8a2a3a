"""Watched folders, stored batches and windows."""

from pyspark.sql import functions as F

from fluvia.streaming import batches

SCHEMA = "id long, kind string, ts timestamp"


def put(spark, path, rows):
    spark.createDataFrame(rows, "id long, kind string, ts string").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(path)


def test_stored_batches_and_totals(spark, tmp_path):
    src, out, ck = (f"{tmp_path}/{x}" for x in ("in", "out", "ck"))
    put(spark, src, [(1, "a", "2024-01-01 00:10:00"), (2, "b", "2024-01-01 00:20:00")])
    batches.store(batches.watch(spark, src, SCHEMA), out, ck).awaitTermination()
    put(spark, src, [(3, "a", "2024-01-01 01:10:00")])
    batches.store(batches.watch(spark, src, SCHEMA), out, ck).awaitTermination()
    assert sorted((r.id, r.batch_id) for r in batches.stored(spark, out, SCHEMA).collect()) == [(1, 0), (2, 0), (3, 1)]
    counts = batches.finished(batches.running_counts(batches.watch(spark, src, SCHEMA, files_per_batch=1), ["kind"]))
    assert sorted((r.kind, r.n) for r in counts.collect()) == [("a", 2), ("b", 1)]


def test_windows(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [(1, "a", "2024-01-01 00:10:00"), (2, "a", "2024-01-01 00:50:00"), (3, "a", "2024-01-01 01:00:00")])
    found = batches.finished(batches.windowed(batches.watch(spark, f"{tmp_path}/in", SCHEMA), F.col("ts"), ["kind"], [F.count("*").alias("n")], "1 hour", "1 day"))
    assert sorted((r.window_start.hour, r.n) for r in found.collect()) == [(0, 2), (1, 1)]


def test_windows_keep_late_rows_within_the_watermark_only(spark, tmp_path):
    # Spark filters late rows by the watermark of the micro-batch before: 10:10 comes before the late row.
    src = f"{tmp_path}/in"
    for i, ts in enumerate(["00:10:00", "10:00:00", "10:10:00", "00:20:00", "09:30:00", "10:40:00"]):
        put(spark, src, [(i, "a", f"2024-01-01 {ts}")])
    made = batches.windowed(batches.watch(spark, src, SCHEMA, files_per_batch=1), F.col("ts"), ["kind"], [F.count("*").alias("n")], "1 hour", "1 hour")
    found = batches.upserted(made, ["window_start", "kind"])
    assert sorted((r.window_start.hour, r.n) for r in found.collect()) == [(0, 1), (9, 1), (10, 3)]


def test_an_empty_stream_has_no_windows(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [(1, "a", "2024-01-01 00:10:00")])
    made = batches.windowed(batches.watch(spark, f"{tmp_path}/in", SCHEMA, names="none*"), F.col("ts"), ["kind"], [F.count("*").alias("n")], "1 hour", "1 hour")
    assert batches.upserted(made, ["window_start", "kind"]).count() == 0
