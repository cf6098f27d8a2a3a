"""Queries of streams with keyed state and of live queries; the catalogue imports them."""

from __future__ import annotations

from pyspark.sql import functions as F

from fluvia.sources.staging import fresh_path
from fluvia.streaming import batches, live, stateful

from . import adapters as A
from .catalogue import _MERGED, _event_stream, query


@query("WITH e AS (SELECT event_type AS stream, event_id AS item, epoch_ms(ts)::BIGINT AS ms FROM events), t AS (SELECT *, (ms - min(ms) OVER (PARTITION BY stream)) // 3600000 AS tick FROM e), p AS (SELECT *, (row_number() OVER (PARTITION BY stream, tick ORDER BY ms, item) - 1) // 4 AS part FROM t) SELECT stream, item, (dense_rank() OVER (PARTITION BY stream ORDER BY tick, part) - 1)::BIGINT AS number FROM p")
def stream_count_or_tick(spark, d):
    rows = _event_stream(spark, d).select(F.col("event_type").alias("stream"), "ts", F.col("event_id").alias("item"))
    return stateful.batched(rows, 4, 3600, late="30 days").select("stream", "item", "number")


@query("WITH e AS (SELECT event_type AS stream, event_id AS item, ts FROM events) SELECT stream, item, ((row_number() OVER (PARTITION BY stream ORDER BY epoch_ms(ts), item) - 1) // 50)::BIGINT AS number FROM e")
def stream_count_batches(spark, d):
    rows = _event_stream(spark, d).select(F.col("event_type").alias("stream"), "ts", F.col("event_id").alias("item"))
    return stateful.batched(rows, 50, None, late="30 days").select("stream", "item", "number")


_EVERY = 20


@query(f"""WITH RECURSIVE {_MERGED}, nb AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY batch_id) AS batches, count(*) OVER (PARTITION BY sample_id) AS last FROM (SELECT DISTINCT sample_id, batch_id FROM bc)),
due AS (SELECT * FROM nb WHERE batches = 1 OR batches % {_EVERY} = 0 OR batches = last),
own AS (SELECT bc.sample_id, nb.batches AS b, bc.taxid, coalesce(bd.reads, 0) AS reads, bc.cumul FROM bc JOIN nb USING (sample_id, batch_id) LEFT JOIN bd USING (sample_id, batch_id, taxid))
SELECT due.sample_id, due.batches, own.taxid, sum(own.reads)::BIGINT AS reads, sum(own.cumul)::BIGINT AS cumul, any_value(tax.rank) AS rank, any_value(tax.name) AS name, any_value(tax.parent) AS parent
FROM due JOIN own ON own.sample_id = due.sample_id AND own.b <= due.batches JOIN tax ON tax.taxid = own.taxid GROUP BY ALL""")
def stream_running_taxa(spark, d):
    path = fresh_path(spark, "batch-reports")
    A.batch_reports(spark, d).drop("row_no").write.parquet(path)
    return stateful.reported(batches.watch(spark, path, spark.read.parquet(path).schema), _EVERY)


@query(f"WITH {A.ALN}, b AS (SELECT sample_id, taxid, batch_id, count(*) AS total, count(*) FILTER (mapq >= 10) AS hits FROM aln GROUP BY ALL) SELECT sample_id, taxid, string_agg(batch_id::VARCHAR, ',' ORDER BY batch_id) AS batches, sum(total)::BIGINT AS total, sum(hits)::BIGINT AS hits FROM b GROUP BY ALL")
def stream_results_by_batch(spark, d):
    path = fresh_path(spark, "batch-results")
    own = A.alignments(spark, d).groupBy("sample_id", "taxid", "batch_id").agg(F.count("*").alias("total"), F.count_if(F.col("mapq") >= 10).alias("hits"))
    own.withColumn("arrival", F.col("batch_id")).write.parquet(path)
    found = stateful.accumulated(batches.watch(spark, path, spark.read.parquet(path).schema))
    return found.withColumn("batches", F.array_join("batches", ","))


@query("SELECT count(*) AS total_files, sum(floor(value * 1000000)::BIGINT)::BIGINT AS total_bytes FROM events")
def stream_session_totals(spark, d):
    path = fresh_path(spark, "session")
    totals = {"files": F.count("*"), "bytes": F.sum(F.floor(F.col("value") * 1_000_000))}
    found = live.carry(_event_stream(spark, d), totals, f"{path}/totals", f"{path}/checkpoint")
    return found.agg(F.max_by("total_files", "batch_id").alias("total_files"), F.max_by("total_bytes", "batch_id").alias("total_bytes"))
