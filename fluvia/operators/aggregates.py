"""Aggregations: classifier and report statistics, snapshots, sessions, merges of read statistics, comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import last_n, running_sums


def ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def batch_counts(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("sample_id", "batch_id").agg(F.count("*").alias("total"), F.count_if(F.col("status") == "C").alias("classified"))


def classifier_stats(report: DataFrame) -> DataFrame:
    """By sample: all direct reads, those of ranked rows, those of rank U."""
    known = F.sum(F.when(F.col("rank") != "U", F.col("reads")).otherwise(0))
    other = F.sum(F.when(F.col("rank") == "U", F.col("reads")).otherwise(0))
    return report.groupBy("sample_id").agg(F.sum("reads").alias("total"), known.alias("classified"), other.alias("unclassified")).withColumn("rate", ratio(F.col("classified"), F.col("total")))


def report_stats(report: DataFrame) -> DataFrame:
    """By sample: taxid 1's clade, taxid 0's reads, their rate, distinct taxa. The last row of a repeated taxid counts."""
    last = report.groupBy("sample_id", "taxid").agg(F.max_by(F.struct("reads", "cumul"), "row_no").alias("x"))
    out = last.groupBy("sample_id").agg(
        F.coalesce(F.max(F.when(F.col("taxid") == "1", F.col("x.cumul"))), F.lit(0)).alias("classified"), F.coalesce(F.max(F.when(F.col("taxid") == "0", F.col("x.reads"))), F.lit(0)).alias("unclassified"), F.count("*").alias("unique_taxa")
    )
    total = F.col("classified") + F.col("unclassified")
    return out.select("sample_id", "classified", "unclassified", total.alias("total"), ratio(F.col("classified"), total).alias("rate"), "unique_taxa")


def completeness(found: DataFrame, expected: DataFrame) -> DataFrame:
    """(sample_id, found, expected, complete): complete where nothing was expected."""
    out = found.groupBy("sample_id").agg(F.count_distinct("batch_id").alias("found")).join(expected, "sample_id", "full")
    n, e = F.coalesce("found", F.lit(0)), F.coalesce("expected", F.lit(0))
    return out.select("sample_id", n.alias("found"), e.alias("expected"), ((e == 0) | (n >= e)).alias("complete"))


def wide_matrix(counts: DataFrame, samples: list[str]) -> DataFrame:
    """taxid x sample, 0 where a sample lacks the taxon."""
    return counts.groupBy("taxid").pivot("sample_id", samples).agg(F.sum("n")).na.fill(0)


def snapshot(files: DataFrame, keys: list[str]) -> DataFrame:
    """Per batch: counts, sizes, reads, compression, priorities, ages and ratios of files."""
    n = F.count("*")
    return files.groupBy(*keys).agg(
        n.alias("files"), F.sum("file_size").alias("total_bytes"), F.round(F.sum("file_size") / F.lit(1024.0 * 1024.0), 2).alias("total_mb"), F.sum("estimated_reads").alias("reads"), F.count_if("is_compressed").alias("compressed"),
        F.avg("priority_score").alias("avg_priority"), F.max("priority_score").alias("max_priority"), F.min("priority_score").alias("min_priority"), F.count_if(F.col("priority_score") > 100).alias("high_priority"),
        F.max("file_age_ms").alias("oldest_ms"), F.min("file_age_ms").alias("newest_ms"), ratio(F.count_if(F.col("file_size") > 50 * 1024 * 1024), n).alias("large_ratio"), ratio(F.count_if("is_compressed"), n).alias("compressed_ratio"),
    )


def directory_counts(files: DataFrame) -> DataFrame:
    return files.groupBy("batch_id", "watch_dir").agg(F.count("*").alias("files"))


def session(snapshots: DataFrame) -> DataFrame:
    """Running totals over batches; the sizes summed are the batches' rounded megabytes."""
    own = snapshots.select("batch_id", "files", "reads", F.round(F.col("total_mb") * 100).cast("long").alias("_mb"))
    s = running_sums(own, "batch_id", {"batches": F.lit(1), "total_files": F.col("files"), "total_reads": F.col("reads"), "_total": F.col("_mb")})
    return s.select(
        "batch_id", F.col("batches").cast("long").alias("batches"), "total_files", "total_reads", (F.col("_total") / 100).alias("total_mb"),
        ratio(F.col("total_files"), F.col("batches")).alias("files_per_batch"), ratio(F.col("total_reads"), F.col("batches")).alias("reads_per_batch"),
    )


def session_report(snapshots: DataFrame) -> DataFrame:
    """Totals, averages, rates and duration of a session at each batch, from snapshot() rows with batch_id and at_ms, when
    the batch was done. The session starts with its first batch; rates are 0 until time has passed. Figures have two places,
    those of reads none, halves up; the sizes summed are the batches' rounded megabytes."""
    own = snapshots.withColumn("_mb", F.round(F.col("total_mb") * 100).cast("long"))
    sums = {"total_batches": F.lit(1), "total_files": F.col("files"), "total_bytes_so_far": F.col("total_bytes"), "_total": F.col("_mb"), "total_reads": F.col("reads"), "total_compressed": F.col("compressed")}
    s = running_sums(own.select("batch_id", "at_ms", "files", "total_bytes", "_mb", "reads", "compressed"), "batch_id", sums)
    start = snapshots.agg(F.min_by("at_ms", "batch_id").alias("_start"))  # one row
    s = s.crossJoin(F.broadcast(start)).withColumns({"_s": (F.col("at_ms") - F.col("_start")) / F.lit(1000.0), "_all_mb": F.col("_total") / F.lit(100.0)})
    near = lambda x, places: F.floor(x * 10**places + 0.5) / 10**places
    rate = lambda a, places=2, by=1.0: near(F.when(F.col("_s") > 0, F.col(a).cast("double") / F.col("_s") * F.lit(by)).otherwise(0.0), places)
    mean = lambda a, b, places=2: near(ratio(F.col(a), F.col(b)), places)
    n = lambda c: F.col(c).cast("long")
    return s.select(
        "batch_id", n("total_batches").alias("total_batches"), n("total_files").alias("total_files"), n("total_bytes_so_far").alias("total_bytes"), F.col("_all_mb").alias("total_mb"), n("total_reads").alias("total_reads"), n("total_compressed").alias("total_compressed"),
        near(F.col("_s"), 2).alias("duration_seconds"), rate("total_files").alias("files_per_second"), rate("_all_mb").alias("mb_per_second"), rate("total_reads", 0).alias("reads_per_second"), rate("total_batches", 2, 60.0).alias("batches_per_minute"),
        mean("total_files", "total_batches").alias("files_per_batch"), mean("_all_mb", "total_batches").alias("mb_per_batch"), mean("total_reads", "total_batches", 0).alias("reads_per_batch"), mean("_all_mb", "total_files").alias("mb_per_file"),
    )


#: The trends of a session and the columns of a snapshot they follow.
TRENDS = {"batch_timestamps": "at_ms", "batch_file_counts": "files", "batch_sizes_mb": "total_mb", "batch_read_counts": "reads", "compression_ratios": "compressed_ratio", "priority_scores": "avg_priority", "large_file_ratios": "large_ratio"}


def session_trends(snapshots: DataFrame, n: int = 100) -> DataFrame:
    """(batch_id, trends): each figure of TRENDS over the last n batches, oldest first, in one pass."""
    own = snapshots.select("batch_id", F.struct(*(F.col(c).alias(k) for k, c in TRENDS.items())).alias("_x"))
    return last_n(own, [], "batch_id", "_x", n).select("batch_id", *(F.col(f"trend.{k}").alias(k) for k in TRENDS))


def distinct_so_far(files: DataFrame, key: str) -> DataFrame:
    """(batch_id, new, known): values of key first seen in a batch, and seen until then."""
    first = files.groupBy(key).agg(F.min("batch_id").alias("batch_id")).groupBy("batch_id").agg(F.count("*").alias("new"))
    batches = files.select("batch_id").distinct().join(first, "batch_id", "left").na.fill(0, ["new"])
    return running_sums(batches, "batch_id", {"known": F.col("new")}).select("batch_id", "new", "known")


def alerts(state: DataFrame, min_files: float | None = None, max_age_ms: float | None = None, min_compressed: float | None = None) -> DataFrame:
    """(batch_id, type, level, metric, value, threshold) for each rule that a batch breaks."""
    rules = [("throughput", "warning", "files", min_files, False), ("file_age", "warning", "oldest_ms", max_age_ms, True), ("compression", "info", "compressed_ratio", min_compressed, False)]
    found = []
    for kind, level, metric, bound, above in rules:
        if bound is not None:
            value = F.col(metric).cast("double")
            found.append(F.when(value > bound if above else value < bound, F.struct(F.lit(kind).alias("type"), F.lit(level).alias("level"), F.lit(metric).alias("metric"), value.alias("value"), F.lit(float(bound)).alias("threshold"))))
    return state.select("batch_id", F.explode(F.array_compact(F.array(*found))).alias("a")).select("batch_id", "a.*")


def merge_read_stats(stats: DataFrame, keys: list[str]) -> DataFrame:
    """Merge read statistics of batches: sums, extremes over batches with reads, rates weighted by bases; the quartiles
    and N50 of the merged set are estimates from its mean length. sum_gap and sum_n are summed where stats have them."""
    w = lambda c: F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("sum_len")), F.sum("sum_len")), F.lit(0.0))
    some = F.col("num_seqs") > 0
    out = stats.groupBy(*keys).agg(
        F.sum("num_seqs").alias("num_seqs"), F.sum("sum_len").alias("sum_len"), F.coalesce(F.min(F.when(some, F.col("min_len"))), F.lit(0)).alias("min_len"), F.coalesce(F.max(F.when(some, F.col("max_len"))), F.lit(0)).alias("max_len"),
        w("q20").alias("q20"), w("q30").alias("q30"), w("avg_qual").alias("avg_qual"), w("gc").alias("gc"),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("sum_gap", "sum_n") if c in stats.columns),
    )
    mean = ratio(F.col("sum_len"), F.col("num_seqs"))
    return out.withColumns({"avg_len": mean, "q1": mean * 0.75, "q2": mean, "q3": mean * 1.5, "n50": F.floor(mean).cast("long"), "n50_num": F.floor(F.col("num_seqs") / 2).cast("long")})


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by order."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_x")).select(*keys, "_x.*")


def read_set_stats(reads: DataFrame, keys: list[str]) -> DataFrame:
    """num_seqs, sum_len, min_len, avg_len, max_len and the exact quartiles of lengths."""
    n = F.length("sequence")
    return reads.groupBy(*keys).agg(F.count("*").alias("num_seqs"), F.sum(n).alias("sum_len"), F.min(n).alias("min_len"), F.avg(n).alias("avg_len"), F.max(n).alias("max_len"), *(F.percentile(n, q).alias(f"q{i}") for i, q in ((1, 0.25), (2, 0.5), (3, 0.75))))


def compare_tools(stats: DataFrame) -> DataFrame:
    """Per tool from (tool, reads_before, reads_after, quality_before, quality_after): retention, quality gain, efficiency."""
    keep, gain = ratio(F.col("reads_after"), F.col("reads_before")), F.col("quality_after") - F.col("quality_before")
    return stats.select("tool", keep.alias("retention"), gain.alias("quality_delta"), (gain / (F.lit(1.0) - keep + 0.001)).alias("efficiency"), "quality_after")


def recommendations(compared: DataFrame) -> DataFrame:
    rules = [(F.col("retention") < 0.7, "relax filters: many reads are lost"), (F.col("quality_delta") < 0.05, "little gain in quality"), (F.col("quality_after") > 12, "high quality after filtering")]
    return compared.select("tool", F.explode(F.array_compact(F.array(*(F.when(c, F.lit(t)) for c, t in rules)))).alias("advice"))


def advice(compared: DataFrame) -> DataFrame:
    """(tool, advice) by each tool's own rules from (tool, retention, quality_delta, quality_after, q30); advice that needs
    both tools, or none, has no tool. An unknown or zero quality or share says nothing."""
    t = lambda name: F.col("tool") == name
    some = lambda c: F.col(c).isNotNull() & (F.col(c) != 0)
    rules = [
        (t("fastp") & (F.col("retention") < 0.7), "relax_filters"), (t("fastp") & (F.col("quality_delta") < 0.05), "little_gain"),
        (t("chopper") & some("quality_after") & (F.col("quality_after") > 12), "good_default"), (t("chopper") & some("q30") & (F.col("q30") < 50), "low_q30"),
    ]
    own = compared.select("tool", F.explode(F.array_compact(F.array(*(F.when(c, F.lit(x)) for c, x in rules)))).alias("advice"))
    both = compared.agg((F.bool_or(t("chopper")) & F.bool_or(t("fastp"))).alias("both"))
    general = F.concat(F.when(F.col("both"), F.array(F.lit("chopper_is_faster"), F.lit("prefer_native_tools"))).otherwise(F.array().cast("array<string>")), F.array(F.lit("monitor_resources"), F.lit("choose_by_aim")))
    return own.unionByName(both.select(F.lit(None).cast("string").alias("tool"), F.explode(general).alias("advice")))


def coverage(tests: DataFrame) -> DataFrame:
    """(component, priority, tests, covered, percent) from rows (component, priority, hit): each pair, each component, all
    components of P0 and P1 together ('all', 'P0+P1') and all ('all', 'all'). A missing component or priority counts in
    the totals only."""
    pairs = tests.groupBy("component", "priority").agg(F.count("*").alias("tests"), F.count_if("hit").alias("covered"))
    urgent = F.col("priority").isin("P0", "P1")
    levels = F.array_compact(F.array(
        F.when(F.col("component").isNotNull() & F.col("priority").isNotNull(), F.struct("component", "priority")),
        F.when(F.col("component").isNotNull(), F.struct(F.col("component").alias("component"), F.lit("all").alias("priority"))),
        F.when(urgent, F.struct(F.lit("all").alias("component"), F.lit("P0+P1").alias("priority"))),
        F.struct(F.lit("all").alias("component"), F.lit("all").alias("priority")),
    ))
    out = pairs.select(F.explode(levels).alias("_l"), "tests", "covered").groupBy("_l").agg(F.sum("tests").alias("tests"), F.sum("covered").alias("covered"))
    return out.select("_l.*", "tests", "covered", (ratio(F.col("covered"), F.col("tests")) * 100).alias("percent"))


def qc_records(tool: str, category: str, reads: DataFrame, side: DataFrame | None = None, stats: DataFrame | None = None, optional: bool = False) -> DataFrame:
    """A tool's records for comparison: (sample_id, tool, category, reads, side, stats), structs of the other columns of the
    three, each keyed by sample_id. side is what the tool says of itself (a report or a log). A sample that lacks a part is
    left out; where the side is optional, it, or the reads, may be null. A part that is not given is null."""
    packed = lambda t, name: t.select("sample_id", F.struct(*(c for c in t.columns if c != "sample_id")).alias(name))
    out = packed(reads, "reads")
    for part, name, how in ((side, "side", "full" if optional else "inner"), (stats, "stats", "inner")):
        out = out.join(packed(part, name), "sample_id", how) if part is not None else out.withColumn(name, F.lit(None))
    return out.select("sample_id", F.lit(tool).alias("tool"), F.lit(category).alias("category"), "reads", "side", "stats")


def regressions(baseline: DataFrame, current: DataFrame, threshold: float = 0.1) -> DataFrame:
    """(name, delta, verdict) of tests in both runs; a baseline of 0 is left out."""
    out = baseline.select("name", F.col("value").alias("_b")).join(current.select("name", F.col("value").alias("_c")), "name").filter("_b <> 0")
    delta = (F.col("_c") - F.col("_b")) / F.col("_b")
    return out.select("name", delta.alias("delta"), F.when(delta > threshold, "regression").when(delta < -threshold, "improvement").otherwise("stable").alias("verdict"))


def trace_stats(trace: DataFrame) -> DataFrame:
    return trace.groupBy("name").agg(F.count("*").alias("tasks"), F.avg("duration_ms").alias("avg_duration_ms"), F.max("memory_mb").alias("max_memory_mb"), F.avg("cpu").alias("avg_cpu"))


def collate_versions(rows: DataFrame) -> DataFrame:
    """(process, versions): distinct tool: version lines of each process, sorted."""
    name = F.substring_index("process", ":", -1)
    return rows.select(name.alias("process"), F.concat_ws(": ", "tool", "version").alias("v")).distinct().groupBy("process").agg(F.array_join(F.array_sort(F.collect_set("v")), "\n").alias("versions"))


def depth_window(alignments: DataFrame, keys: list[str], min_depth: int) -> DataFrame:
    """Per contig: first and last position of at least min_depth, how many there are, and their depths' sum.

    Depth changes only where an alignment starts or ends, so events are summed, not positions.
    """
    ends = alignments.select(*keys, F.explode(F.array(F.struct(F.col("tstart").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("tend").alias("pos"), F.lit(-1).alias("d")))).alias("e")).select(*keys, "e.*")
    steps = ends.groupBy(*keys, "pos").agg(F.sum("d").alias("d"))
    w = Window.partitionBy(*keys).orderBy("pos")
    runs = steps.select(*keys, "pos", F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("depth"), F.lead("pos").over(w).alias("to")).filter((F.col("depth") >= min_depth) & F.col("to").isNotNull())
    return runs.groupBy(*keys).agg(F.min("pos").alias("first_pos"), (F.max("to") - 1).alias("last_pos"), F.sum(F.col("to") - F.col("pos")).alias("positions"), F.sum((F.col("to") - F.col("pos")) * F.col("depth")).alias("bases"))
