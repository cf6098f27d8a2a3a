"""Inputs of a run: file listings as samples, checks of what was given, and small lookups around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fluvia.functions.scalars import basename, fastq_stem, parent_dir

#: Names of read files, of a barcode's folder, and of the folder of reads without a barcode.
FASTQ, BARCODE_DIR, UNCLASSIFIED = r"\.(fastq|fq)(\.gz)?$", r"^barcode\d+$", "unclassified"


def listing(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """(path, size) of the files under a folder; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    return files.select("path", F.col("length").alias("size"))


def visible_reads(files: DataFrame) -> DataFrame:
    """Read files whose name does not start with a dot."""
    return files.filter(F.col("path").rlike(FASTQ) & ~basename(F.col("path")).startswith("."))


def structure(files: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """(root, structure): barcode_subdirs where a folder of the root that is named like a barcode holds read files, else
    flat. Of given roots (root), folders without a slash at the end, each has a row, whatever lies in it or deeper; without
    them the root is the folder above a barcode's folder, or else a file's own folder."""
    folder, above = F.regexp_replace("path", "/?[^/]*$", ""), F.regexp_replace("path", "/?[^/]*/[^/]*$", "")
    named = parent_dir(F.col("path")).rlike(BARCODE_DIR)
    if roots is None:
        found = files.groupBy(F.when(named, above).otherwise(folder).alias("root"))
        return found.agg(F.when(F.bool_or(named & F.col("path").rlike(FASTQ)), "barcode_subdirs").otherwise("flat").alias("structure"))
    barcodes = files.filter(named & F.col("path").rlike(FASTQ)).select(above.alias("root"), F.lit(True).alias("_b")).distinct()
    return roots.select("root").distinct().join(barcodes, "root", "left").select("root", F.when(F.col("_b"), "barcode_subdirs").otherwise("flat").alias("structure"))


def by_sample(files: DataFrame, sample: Column) -> DataFrame:
    """(sample_id, n_files, files): a sample's distinct paths, sorted."""
    return files.select(sample.alias("sample_id"), "path").distinct().groupBy("sample_id").agg(F.count("*").alias("n_files"), F.array_sort(F.collect_list("path")).alias("files"))


def barcode_samples(files: DataFrame) -> DataFrame:
    """A sample for each barcode's folder, and one for reads without a barcode; folders without read files have none."""
    parent = parent_dir(F.col("path"))
    return by_sample(visible_reads(files).filter(parent.rlike(BARCODE_DIR) | (parent == UNCLASSIFIED)), parent)


def flat_samples(files: DataFrame, sample: Column | None = None) -> DataFrame:
    """A sample for each stem (or other name) of the read files, wherever they lie."""
    return by_sample(visible_reads(files), fastq_stem(F.col("path")) if sample is None else sample)


def pair_by_suffix(files: DataFrame, suffixes: dict[str, str]) -> DataFrame:
    """(sample_id, a column for each suffix): the first path that is the sample's name and the suffix; null if none."""
    longest = sorted(suffixes.items(), key=lambda x: -len(x[1]))
    kind = F.coalesce(*(F.when(F.col("path").endswith(s), k) for k, s in longest))
    name = F.coalesce(*(F.when(F.col("path").endswith(s), F.substring(basename(F.col("path")), F.lit(1), F.length(basename(F.col("path"))) - len(s))) for _, s in longest))
    rows = files.select(name.alias("sample_id"), kind.alias("_kind"), "path").filter("_kind is not null")
    return rows.groupBy("sample_id").agg(*(F.min(F.when(F.col("_kind") == k, F.col("path"))).alias(k) for k in suffixes))


def non_empty(files: DataFrame, keys: list[str], least: int = 50) -> DataFrame:
    """(keys, passed): whether any file has `least` bytes."""
    return files.groupBy(*keys).agg(F.coalesce(F.bool_or(F.col("size") >= least), F.lit(False)).alias("passed"))


def uneven_samples(rows: DataFrame, key: str, flag: str) -> DataFrame:
    """Samples whose rows do not agree on a flag, nulls being a value of their own."""
    return rows.groupBy(key).agg((F.count_distinct(flag) + F.max(F.col(flag).isNull().cast("int"))).alias("kinds")).filter("kinds > 1")


def input_mode(given: dict[str, Column]) -> Column:
    """The name of the one input that is given; `none` or `several` else."""
    n = sum((F.coalesce(c, F.lit(False)).cast("int") for c in given.values()), F.lit(0))
    return F.when(n > 1, "several").otherwise(F.coalesce(*(F.when(c, k) for k, c in given.items()), F.lit("none")))


def task_outcome(exit_code: Column, attempt: Column, retries: int = 2) -> Column:
    """ok, drop (the sample goes, others stay), retry or fail."""
    return F.when(exit_code == 0, "ok").when(exit_code.isin(1, 2), "drop").when(attempt <= retries, "retry").otherwise("fail")


def in_batch_order(rows: DataFrame, keys: list[str], batch: str, name: str = "place") -> DataFrame:
    """Rows numbered within keys by the number in a batch's name; names without one come last, by name."""
    n = F.regexp_extract(batch, r"batch_(\d+)", 1).try_cast("long")
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(n.asc_nulls_last(), batch)).cast("long"))


def first_and_more(values: Column, n: int = 5) -> Column:
    """The first n of a sorted array as text, with how many more there are."""
    more = F.size(values) - n
    return F.concat(F.array_join(F.slice(values, 1, n), ", "), F.when(more > 0, F.concat(F.lit(" and "), more.cast("string"), F.lit(" more"))).otherwise(""))


def count_or_timer_batches(rows: DataFrame, ts: str, order: str, n: int, seconds: int) -> DataFrame:
    """(..., tick, batch_in_tick): a buffer is a batch when it holds n rows, and whatever it holds when the timer ticks
    at its fixed rate. So batches never span a tick, and each tick is a partition of its own."""
    tick = F.floor(F.unix_timestamp(ts) / seconds).cast("long")
    w = Window.partitionBy("tick").orderBy(order)
    return rows.withColumn("tick", tick).withColumn("batch_in_tick", F.floor((F.row_number().over(w) - 1) / n).cast("long"))


def within_budget(rows: DataFrame, ts: str, minutes: float, grace: float = 0, start: Column | None = None) -> DataFrame:
    """Rows that come within minutes + grace of the run's start, or else of the first row; to the microsecond."""
    first = rows.agg(F.min(ts).cast("timestamp").alias("_start")) if start is None else rows.sparkSession.range(1).select(start.cast("timestamp").alias("_start"))
    end = F.timestamp_micros(F.unix_micros("_start") + round((minutes + grace) * 60_000_000))
    return rows.join(F.broadcast(first), F.col(ts).cast("timestamp") <= end).drop("_start")


def with_fallback(stats: DataFrame, counts: DataFrame, keys: list[str], column: str, fallback: str) -> DataFrame:
    """stats with a looked-up column, or their own where there is none."""
    return stats.join(counts.select(*keys, F.col(column).alias("_found")), keys, "left").withColumn(column, F.coalesce("_found", fallback)).drop("_found")


def without(rows: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among others', such as reads of a contaminant."""
    return rows.join(others.select(key), key, "left_anti")


def path_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd_HH-mm-ss")


def iso_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def run_snapshot(files: DataFrame) -> DataFrame:
    """One row: files, batches, barcodes, and the range of priorities and sizes."""
    return files.agg(
        F.count("*").alias("files"), F.count_distinct("batch_id").alias("batches"), F.count_distinct("sample_id").alias("barcodes"), F.min("priority_score").alias("min_priority"),
        F.max("priority_score").alias("max_priority"), F.min("file_size").alias("min_size"), F.max("file_size").alias("max_size"),
    )
