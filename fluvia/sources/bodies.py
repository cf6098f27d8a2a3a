"""Bodies of result files as lines (file, row_no, value) for committed.write: QC and assembly results, what goes beside
them, validation tables and reads. Lists of a body are one line an element, so no sample's elements meet in one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvia.operators.reads import assembly_summary

from .staging import staged_with

#: The first and the last line of a body, whatever the numbers of those between are.
FIRST, LAST = -1, (1 << 63) - 1
FORMAT = "1.0.0"


def fixed_text(x: Column, places: int) -> Column:
    """A number of at least 0 with fixed places, halves up in double arithmetic; null stays null."""
    scaled = F.floor(x.cast("double") * 10**places + 0.5).cast("long")
    if not places:
        return scaled.cast("string")
    return F.concat(F.floor(scaled / 10**places).cast("string"), F.lit("."), F.lpad((scaled % 10**places).cast("string"), places, "0"))


def rounded(x: Column, places: int = 6) -> Column:
    return F.floor(x * 10**places + 0.5) / 10**places


def _file(stem: Column, suffix: str) -> Column:
    return F.concat(F.regexp_replace(F.coalesce(stem, F.lit("none")), "[^A-Za-z0-9._-]", "_"), F.lit(suffix))


def assembly_lines(contigs: DataFrame, bases: DataFrame, suffix: str = ".assembly.json") -> DataFrame:
    """A body of each sample's assembly: summary first, then the contigs by place.

    contigs: (sample_id, place, name, length, coverage, circular, repeat), place from 0 on; repeat is null where there is
    none. bases: (sample_id, name, gc, acgt) of sequences; of a name that comes again the greatest shares count. A contig
    without bases has no gc_content, a sample without any neither. Fields that are null are left out.
    """
    k = ["sample_id"]
    share = lambda: rounded(F.try_divide(F.col("gc").cast("double"), F.col("acgt")))
    own = bases.groupBy("sample_id", "name").agg(F.max(F.when(F.col("acgt") > 0, share())).alias("_gc"))
    total = bases.groupBy("sample_id").agg(F.sum("gc").alias("gc"), F.sum("acgt").alias("acgt")).select("sample_id", share().alias("_all"))
    s = assembly_summary(contigs, k).join(contigs.groupBy("sample_id").agg(F.min("place").alias("_first")), k).join(total, k, "left")
    summary = F.struct("total_contigs", "total_length", F.col("longest").alias("largest_contig"), "n50", "l50", "circular_contigs", F.col("_all").alias("gc_content"))
    head = F.to_json(F.struct(F.lit(FORMAT).alias("format_version"), "sample_id", summary.alias("summary")))
    file = _file(F.col("sample_id"), suffix)
    lines = s.withColumn("_h", head)
    opened = lines.select(file.alias("file"), F.lit(FIRST).cast("long").alias("row_no"), F.concat(F.expr("left(_h, length(_h) - 1)"), F.lit(',"contigs":[')).alias("value"))
    closed = lines.select(file.alias("file"), F.lit(LAST).cast("long").alias("row_no"), F.lit("]}").alias("value"))
    c = contigs.join(own, ["sample_id", "name"], "left").join(s.select("sample_id", "_first"), "sample_id")
    body = F.to_json(F.struct("name", "length", "coverage", F.col("circular").alias("is_circular"), F.when(F.col("repeat") > 0, F.col("repeat")).alias("repeat_fraction"), F.col("_gc").alias("gc_content")))
    rows = c.select(file.alias("file"), F.col("place").cast("long").alias("row_no"), F.concat(F.when(F.col("place") > F.col("_first"), ",").otherwise(""), body).alias("value"))
    return opened.unionByName(rows).unionByName(closed)


_COUNTS = ("passed_filter_reads", "low_quality_reads", "too_short_reads", "too_long_reads", "too_many_n_reads", "adapter_trimmed_reads")


def qc_lines(stats: DataFrame, suffix: str = ".qc.json") -> DataFrame:
    """A body of each sample's QC, one line: (sample_id, before, after, reasons), structs of figures of which before and
    reasons may be null. A body always has before_filtering, if only as null; null figures within are left out."""
    part = lambda c: F.coalesce(F.to_json(c), F.lit("null"))
    head = F.to_json(F.struct(F.lit(FORMAT).alias("format_version"), "sample_id"))
    body = F.concat(
        F.expr("left(_h, length(_h) - 1)"), F.lit(',"before_filtering":'), part("before"), F.lit(',"after_filtering":'), F.coalesce(F.to_json("after"), F.lit("{}")),
        F.when(F.col("reasons").isNotNull(), F.concat(F.lit(',"filtering_result":'), F.to_json("reasons"))).otherwise(""), F.lit("}"),
    )
    return stats.withColumn("_h", head).select(_file(F.col("sample_id"), suffix).alias("file"), F.lit(0).cast("long").alias("row_no"), body.alias("value"))


def seqkit_qc(stats: DataFrame) -> DataFrame:
    """qc_lines() input of read statistics (sample_id, num_seqs, sum_len, avg_len, q20, q30, gc, n50), rates as shares."""
    after = F.struct(F.col("num_seqs").alias("total_reads"), F.col("sum_len").alias("total_bases"), rounded(F.col("q20")).alias("q20_rate"), rounded(F.col("q30")).alias("q30_rate"), rounded(F.col("gc")).alias("gc_content"), F.col("avg_len").alias("mean_length"), "n50")
    none = F.lit(None).cast("struct<n: long>")
    return stats.select("sample_id", none.alias("before"), after.alias("after"), none.alias("reasons"))


def fastp_qc(found: DataFrame) -> DataFrame:
    """qc_lines() input of formats.fastp() rows with sample_id; counts that the file lacks are 0."""
    side = lambda s: F.struct(*(F.col(f"{s}_{c}").alias(n) for c, n in (("total_reads", "total_reads"), ("total_bases", "total_bases"), ("q20_rate", "q20_rate"), ("q30_rate", "q30_rate"), ("gc_content", "gc_content"), ("read1_mean_length", "mean_length"))))
    names = {c.lower(): c for c in found.columns}
    reasons = F.struct(*((F.col(names[c]) if c in names else F.lit(0).cast("long")).alias(c) for c in _COUNTS))
    return found.select("sample_id", side("before").alias("before"), side("after").alias("after"), reasons.alias("reasons"))


def sidecar_lines(results: DataFrame, category: str, tool: str, version: str, now: Column, suffix: str, mode: str | None = None, **more: Column) -> DataFrame:
    """What stands beside a result: (sample_id, source_files) rows become one line each; `more`, such as is_cumulative or
    batch_id, follows, null fields are left out."""
    made = F.struct(
        F.lit(FORMAT).alias("contract_version"), F.lit(category).alias("category"), F.struct(F.lit(tool).alias("name"), F.lit(version).alias("version")).alias("tool"), "sample_id",
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), F.lit(FORMAT).alias("format_version"), F.lit(mode).alias("mode"), "source_files", *(c.alias(k) for k, c in more.items()),
    )
    return results.select(_file(F.col("sample_id"), suffix).alias("file"), F.lit(0).cast("long").alias("row_no"), F.to_json(made).alias("value"))


TABLE = ("sample_id", "taxid", "species", "method", "kraken_reads", "hits", "hit_rate", "avg_identity", "avg_coverage", "status")


def validation_lines(verdicts: DataFrame, order: Column, file: Column) -> DataFrame:
    """Tab-separated tables of verdicts (the columns of TABLE), the header first, then rows by a whole-number order from 0
    on; rates have four places, identities two."""
    at = {"hit_rate": 4, "avg_identity": 2, "avg_coverage": 4}
    text = [F.coalesce(fixed_text(F.col(c), at[c]) if c in at else F.col(c).cast("string"), F.lit("")) for c in TABLE]
    rows = verdicts.select(file.alias("file"), order.cast("long").alias("row_no"), F.concat_ws("\t", *text).alias("value"))
    return rows.unionByName(rows.select("file").distinct().select("file", F.lit(FIRST).cast("long").alias("row_no"), F.lit("\t".join(TABLE)).alias("value")))


#: Samples whose counts are broadcast (some ten bytes each and a name); beyond, the join is left to Spark.
BROADCAST_SAMPLES = 100_000


def fastq_lines(reads: DataFrame, per_file: int = 1_000_000, file_letters: int = 64 << 20) -> DataFrame:
    """FASTQ files of each sample's reads (sample_id, read_id, sequence, quality), of about per_file reads or file_letters
    letters each, whichever makes more files, so that a large sample is many tasks': a read's file is told by a hash of its
    id. A read is one value of four lines; reads are in order of another hash of the id. Only the samples' counts are
    joined, so that reads are shuffled once, by file."""
    named = F.coalesce("sample_id", F.lit("none")).alias("_s")
    letters = F.coalesce(F.sum(F.length("sequence").cast("long") + F.length("quality")), F.lit(0))
    parts = F.greatest(F.ceil(F.count("*") / per_file), F.ceil(letters / file_letters)).cast("long")
    counts, n = staged_with(reads.groupBy(named).agg(parts.alias("_n")), "read-counts", F.lit(True))
    own = reads.withColumn("_s", named).join(F.broadcast(counts) if n <= BROADCAST_SAMPLES else counts, "_s")
    value = F.concat(F.lit("@"), F.coalesce("read_id", F.lit("")), F.lit("\n"), F.coalesce("sequence", F.lit("")), F.lit("\n+\n"), F.coalesce("quality", F.lit("")))
    part = F.pmod(F.xxhash64("read_id"), F.col("_n"))
    return own.select(F.concat(_file(F.col("_s"), ""), F.lit("/"), F.lpad(part.cast("string"), 6, "0"), F.lit(".fastq")).alias("file"), F.xxhash64("read_id", F.lit(1)).alias("row_no"), value.alias("value"))
