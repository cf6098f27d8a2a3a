"""Text and JSON formats of sequencing tools as DataFrames.

Lines are read as text and split, so that short and odd rows follow each format's rule instead of a CSV reader's.
Every reader works on a DataFrame of lines (path, line_no, value), which lines() makes from files; rows keep `path`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fluvia.functions import scalars

from . import records


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, value) of text files. A file is one row first, as only so lines keep their order; for report-sized files."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.split("value", "\r?\n").alias("l"))
    return files.select("path", F.posexplode("l").alias("line_no", "value"))


def rows(spark: SparkSession, path: str) -> DataFrame:
    """(path, value) of text files of any size; the order of lines is not kept."""
    return spark.read.text(path).select(F.input_file_name().alias("path"), "value")


def _fields(df: DataFrame, least: int) -> DataFrame:
    """The tab-separated fields `f` of lines that have enough of them and are no comments."""
    kept = df.filter((F.trim("value") != "") & ~F.col("value").startswith("#")).withColumn("f", F.split("value", "\t"))
    return kept.filter(F.size("f") >= least).drop("value")


def _f(i: int) -> Column:
    return F.get("f", F.lit(i))


def kreport(df: DataFrame) -> DataFrame:
    """Report rows with their depth; rows whose counts are no integers are left out."""
    f = _fields(df, 6)
    own = f.select(
        "path", "line_no", F.trim(_f(0)).try_cast("double").alias("pct"), F.trim(_f(1)).try_cast("long").alias("cumul"), F.trim(_f(2)).try_cast("long").alias("reads"), F.trim(_f(3)).alias("rank"), F.trim(_f(4)).alias("taxid"),
        F.trim(_f(5)).alias("name"), ((F.length(_f(5)) - F.length(F.ltrim(_f(5)))) / 2).cast("int").alias("depth"),
    )
    return own.filter("cumul is not null and reads is not null")


def kreport_strict(df: DataFrame) -> DataFrame:
    """The same, but an error where a number does not parse."""
    f = _fields(df, 6)
    bad = F.trim(_f(0)).try_cast("double").isNull() | F.trim(_f(1)).try_cast("long").isNull() | F.trim(_f(2)).try_cast("long").isNull()
    checked = F.when(bad, F.raise_error(F.concat(F.lit("not a report row: "), F.array_join("f", " ")))).otherwise(F.col("f"))
    return kreport(f.select("path", "line_no", F.array_join(checked, "\t").alias("value")))


def assignments(df: DataFrame) -> DataFrame:
    """One row per read: status C or U, read, taxon, length, k-mers."""
    f = _fields(df, 3)
    return f.select("path", _f(0).alias("status"), _f(1).alias("read_id"), _f(2).alias("taxid"), _f(3).try_cast("long").alias("length"), _f(4).alias("kmers"))


def blast(df: DataFrame) -> DataFrame:
    """Tabular hits of 12 columns, and three more (-1 where they are missing)."""
    f = _fields(df, 12)
    texts, longs, doubles = {"qseqid": 0, "sseqid": 1}, {"length": 3, "mismatch": 4, "gapopen": 5, "qstart": 6, "qend": 7, "sstart": 8, "send": 9}, {"pident": 2, "evalue": 10, "bitscore": 11}
    extra = {"qlen": 12, "slen": 13, "qcovs": 14}
    keep = [c for c in ("path", "line_no") if c in df.columns]
    return f.select(
        *keep, *(_f(i).alias(n) for n, i in texts.items()), *(_f(i).try_cast("long").alias(n) for n, i in longs.items()), *(_f(i).try_cast("double").alias(n) for n, i in doubles.items()),
        *(F.coalesce(_f(i).try_cast("double"), F.lit(-1.0)).alias(n) for n, i in extra.items()),
    )


def paf(df: DataFrame) -> DataFrame:
    """Alignments of 12 columns and tags; identity from the divergence tag, else from matches over length."""
    f = _fields(df, 12)
    longs = {"qlen": 1, "qstart": 2, "qend": 3, "tlen": 6, "tstart": 7, "tend": 8, "nmatch": 9, "alen": 10, "mapq": 11}
    keep = [c for c in ("path", "line_no") if c in df.columns]
    own = f.select(*keep, _f(0).alias("qname"), _f(4).alias("strand"), _f(5).alias("tname"), *(_f(i).try_cast("long").alias(n) for n, i in longs.items()), F.slice("f", 13, F.greatest(F.size("f") - 12, F.lit(0))).alias("tags"))
    dv = F.regexp_extract(F.coalesce(F.get(F.filter("tags", lambda t: t.startswith("dv:f:")), F.lit(0)), F.lit("")), "^dv:f:(.+)$", 1).try_cast("double")
    return own.withColumn("identity", F.coalesce((1 - dv) * 100, F.try_divide(F.col("nmatch") * 100.0, F.col("alen"))))


def seqkit_stats(spark: SparkSession, path: str) -> DataFrame:
    """The first data row of each file, by column name; thousands' commas go, percents become fractions of 6 places."""
    all_lines = lines(spark, path).filter(F.trim("value") != "")
    head = all_lines.filter("line_no = 0").select("path", F.transform(F.split("value", "\t"), F.trim).alias("head"))
    first = all_lines.filter("line_no > 0").groupBy("path").agg(F.min_by("value", "line_no").alias("value"))
    m = first.join(head, "path").withColumn("f", F.transform(F.split("value", "\t"), lambda x: F.replace(F.trim(x), F.lit(","), F.lit(""))))
    m = m.filter(F.size("f") == F.size("head")).select("path", F.map_from_arrays("head", "f").alias("m"))
    number = lambda c: F.coalesce(F.try_element_at("m", F.lit(c)).try_cast("double"), F.lit(0.0))
    whole = {"num_seqs": "num_seqs", "sum_len": "sum_len", "min_len": "min_len", "max_len": "max_len", "N50": "n50"}
    shares = {"Q20(%)": "q20", "Q30(%)": "q30", "GC(%)": "gc"}
    return m.select("path", *(number(c).cast("long").alias(n) for c, n in whole.items()), number("avg_len").alias("avg_len"), number("AvgQual").alias("avg_qual"), *(F.round(number(c) / 100, 6).alias(n) for c, n in shares.items()))


_SIDE = "struct<total_reads: long, total_bases: long, q20_rate: double, q30_rate: double, read1_mean_length: double, gc_content: double>"
_FASTP = f"summary struct<before_filtering: {_SIDE}, after_filtering: {_SIDE}>, filtering_result struct<passed_filter_reads: long, low_quality_reads: long, too_many_N_reads: long, too_short_reads: long, too_long_reads: long>"


def fastp(spark: SparkSession, path: str) -> DataFrame:
    """A file's read counts before and after filtering and the reasons; numbers that are missing are 0."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.from_json("value", _FASTP).alias("j"))
    zero = lambda c, kind: F.coalesce(F.col(c), F.lit(0).cast(kind))
    side = lambda s: [zero(f"j.summary.{s}_filtering.{c}", k).alias(f"{s}_{c}") for c, k in (("total_reads", "long"), ("total_bases", "long"), ("q20_rate", "double"), ("q30_rate", "double"), ("read1_mean_length", "double"), ("gc_content", "double"))]
    reasons = [zero(f"j.filtering_result.{c}", "long").alias(c) for c in ("passed_filter_reads", "low_quality_reads", "too_many_N_reads", "too_short_reads", "too_long_reads")]
    return raw.select("path", *side("before"), *side("after"), *reasons)


def flye_info(df: DataFrame) -> DataFrame:
    """Contigs of an assembly's table: the header (line 0) and rows of under 4 columns go."""
    f = _fields(df.filter("line_no > 0"), 4)
    repeat = F.coalesce(_f(4).try_cast("double"), F.when(F.upper(_f(4)) == "Y", 1.0).otherwise(0.0))
    return f.select("path", _f(0).alias("name"), _f(1).try_cast("long").alias("length"), _f(2).try_cast("double").alias("coverage"), F.lower(F.trim(_f(3))).isin("y", "yes", "+", "true").alias("circular"), F.when(repeat > 0, repeat).alias("repeat"))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, sequence), read in splits that end at records; names end at the first blank, gzip is told by its bytes."""
    return records.read(spark, "fasta", path)


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, value) of text files of any size. Files are read in splits; the lines of a split are numbered as
    they are read, and counts of the splits before it are added. Lines end in \\n, \\r\\n or \\r; empty ones count too."""
    own = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id"), "value")
    counts = own.groupBy("path", "split").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    ahead = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n")
    return own.join(counts, ["path", "split"]).select("path", (F.col("id") - F.col("first") + F.col("ahead")).alias("line_no"), "value")


def fastq(spark: SparkSession, path: str) -> DataFrame:
    """(path, read_id, sequence, quality) of four-line records, read in splits that end at records, without a shuffle."""
    return records.read(spark, "fastq", path)


def genome_map(spark: SparkSession, path: str) -> DataFrame:
    """(taxid, genome) of a JSON object; relative paths are beside the file; a value that is no string is an error."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_replace(F.input_file_name(), "/[^/]*$", "").alias("at"), F.from_json("value", "map<string, string>").alias("m"))
    got = raw.select("at", F.explode("m").alias("taxid", "g"))
    checked = F.when(F.col("g").isNull() | F.col("g").rlike(r"^\s*[{\[]"), F.raise_error(F.concat(F.lit("no path for taxid "), "taxid"))).otherwise(F.col("g"))
    return got.select("taxid", F.when(checked.startswith("/"), checked).otherwise(F.concat_ws("/", "at", checked)).alias("genome"))


def taxon_names(spark: SparkSession, path: str) -> DataFrame:
    """(taxid, name) of a JSON object, without empty names; an unreadable file has no rows."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string, string>").alias("m"))
    return raw.select(F.explode("m").alias("taxid", "name")).filter(F.trim("name") != "")


def samplesheet(spark: SparkSession, path: str) -> DataFrame:
    """(sample_id, barcode, single_end, files): rows of one sample together, the first barcode wins; bad rows are errors."""
    raw = spark.read.csv(path, header=True, schema="sample string, fastq string, barcode string").withColumn("ord", F.monotonically_increasing_id())
    bad = F.coalesce(F.col("sample"), F.lit("")).rlike(r"^$|\s") | ~F.coalesce(F.col("fastq"), F.lit("")).rlike(r"\.f(ast)?q(\.gz)?$")
    own = raw.withColumn("sample", F.when(bad, F.raise_error(F.concat(F.lit("bad samplesheet row: "), F.coalesce("sample", F.lit("")), F.lit(" "), F.coalesce("fastq", F.lit(""))))).otherwise(F.col("sample")))
    files = F.transform(F.array_sort(F.collect_list(F.struct("ord", "fastq"))), lambda x: x["fastq"])
    return own.groupBy(F.col("sample").alias("sample_id")).agg(F.min_by(F.nullif(F.trim("barcode"), F.lit("")), "ord").alias("barcode"), F.lit(True).alias("single_end"), files.alias("files"))


def trace(spark: SparkSession, path: str) -> DataFrame:
    """(name, duration_ms, memory_mb, cpu) of an execution trace."""
    raw = spark.read.csv(path, header=True, sep="\t")
    return raw.select(scalars.process_tail(F.col("name")).alias("name"), scalars.duration_ms(F.col("realtime")).alias("duration_ms"), scalars.memory_mb(F.col("peak_rss")).alias("memory_mb"), F.replace("%cpu", F.lit("%"), F.lit("")).try_cast("double").alias("cpu"))


def filter_log(df: DataFrame) -> DataFrame:
    """(path, reads_in, reads_out) of a read filter's log."""
    found = lambda p: F.max(F.regexp_extract("value", p, 1).try_cast("long"))
    return df.groupBy("path").agg(found(r"(\d+) reads in input").alias("reads_in"), F.coalesce(found(r"(\d+) reads in output"), found(r"(\d+) reads kept")).alias("reads_out"))
