"""Sinks: report text, JSON bodies, result tables and run manifests, as rows and as files.

Spark's committer makes a file visible only when its task's output is committed, so no reader sees half a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent_text(part: Column, whole: Column) -> Column:
    """100 * part / whole with two places, halves up, in whole-number arithmetic; 0.00 where whole is 0."""
    hundredths = F.coalesce(F.floor(F.try_divide(part * 20_000 + whole, whole * 2)), F.lit(0))
    return F.concat(F.floor(hundredths / 100).cast("string"), F.lit("."), F.lpad((hundredths % 100).cast("string"), 2, "0"))


def kreport_lines(report: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, row_no, value) of report rows with the key's `total`: six tab-separated fields, the name indented."""
    fields = [percent_text(F.col("cumul"), F.col("total")), F.col("cumul"), F.col("reads"), F.col("rank"), F.col("taxid"), F.col("name")]
    return report.select(*keys, "row_no", F.concat_ws("\t", *(f.cast("string") for f in fields)).alias("value"))


def empty_report(samples: DataFrame) -> DataFrame:
    """(sample_id, row_no, value): the one line of a sample without reads."""
    return samples.select("sample_id", F.lit(1).alias("row_no"), F.lit("100.00\t0\t0\tU\t0\tunclassified").alias("value"))


def write_texts(lines: DataFrame, path: str, key: str = "sample_id", order: str = "row_no") -> None:
    """One folder of text for each key, its lines in order. A key's lines are one task's, so for report-sized texts."""
    lines.repartition(key).sortWithinPartitions(key, order).select(key, "value").write.mode("overwrite").partitionBy(key).text(path)


def json_bodies(rows: DataFrame, keys: list[str], order: str, mode: str, cumulative: bool) -> DataFrame:
    """(keys, body, sidecar): a key's rows as one JSON array by order, and how they were made. For report-sized keys."""
    rest = [c for c in rows.columns if c not in keys and c != order]
    listed = F.transform(F.array_sort(F.collect_list(F.struct(order, F.struct(*rest).alias("row")))), lambda x: x["row"])
    side = F.to_json(F.struct(F.lit(mode).alias("mode"), F.lit(cumulative).alias("is_cumulative"), F.count("*").alias("rows")))
    return rows.groupBy(*keys).agg(F.to_json(listed).alias("body"), side.alias("sidecar"))


def manifest(samples: DataFrame, produced: DataFrame, suffixes: list[str], now: Column, previous: DataFrame) -> DataFrame:
    """(run_id, started_at, samples, files, failed) of each run.

    samples, produced: (run_id, sample_id); previous: (run_id, started_at, failed). A known start is kept. Each sample
    is expected to have one file of each suffix. failed lists the samples that produced nothing; where a run has no
    rows in produced it cannot be told, and the previous value (or null) stays.
    """
    own = samples.groupBy("run_id").agg(F.array_sort(F.collect_set("sample_id")).alias("samples"))
    made = produced.groupBy("run_id").agg(F.collect_set("sample_id").alias("_made"))
    old = previous.select("run_id", F.col("started_at").alias("_started"), F.col("failed").alias("_failed"))
    files = F.flatten(F.transform(F.array(*map(F.lit, suffixes)), lambda x: F.transform("samples", lambda s: F.concat(s, x))))
    missing = F.when(F.col("_made").isNotNull(), F.array_sort(F.array_except("samples", "_made"))).otherwise(F.col("_failed"))
    out = own.join(made, "run_id", "left").join(old, "run_id", "left")
    return out.select("run_id", F.coalesce("_started", now).alias("started_at"), "samples", F.array_sort(files).alias("files"), missing.alias("failed"))
