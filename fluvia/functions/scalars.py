"""Scalar functions on columns: names of samples and barcodes, sizes, durations, formats. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FASTQ_SUFFIX = r"\.(fastq|fq)(\.gz)?$"


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent_dir(path: Column) -> Column:
    """The last folder's name; empty where the path has none."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) >= 2, F.element_at(parts, -2)).otherwise(F.lit(""))


def fastq_stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), FASTQ_SUFFIX, "")


def extract_barcode(name: Column) -> Column:
    """barcodeNN from the first 'barcode' with digits, any case; padded to two digits, longer numbers kept whole."""
    digits = F.regexp_extract(name, r"(?i)barcode(\d+)", 1)
    return F.when(digits != "", F.concat(F.lit("barcode"), F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits)))


def is_valid_barcode(barcode: Column) -> Column:
    return F.coalesce(barcode.rlike(r"^barcode[0-9]{2}$"), F.lit(False))


def valid_barcode(name: Column) -> Column:
    found = extract_barcode(name)
    return F.when(is_valid_barcode(found), found)


def barcode_number(barcode: Column) -> Column:
    return F.regexp_extract(barcode, r"barcode(\d+)", 1).try_cast("int")


def format_barcode(number: Column) -> Column:
    return F.when(number.between(1, 99), F.concat(F.lit("barcode"), F.lpad(number.cast("string"), 2, "0")))


def sample_id(path: Column, sample_regex: str | None = None, sample_name: str | None = None) -> Column:
    """A barcode folder, else the pattern's first group in the file name, else a barcode in the stem of a file in an
    output folder, else the given name, else the stem."""
    parent, stem = parent_dir(path), fastq_stem(path)
    steps = [F.when(parent.rlike(r"^barcode\d+$"), parent)]
    if sample_regex:
        steps.append(F.nullif(F.regexp_extract(basename(path), sample_regex, 1), F.lit("")))
    steps.append(F.when(parent.isin("fastq_pass", "output"), extract_barcode(stem)))
    if sample_name:
        steps.append(F.lit(sample_name))
    return F.coalesce(*steps, stem)


def estimated_reads(size: Column, compressed: Column) -> Column:
    return F.floor(F.when(compressed, size * 4).otherwise(size) / 4000).cast("long")


def megabytes(size: Column) -> Column:
    return F.round(size / F.lit(1024.0 * 1024.0), 2)


def duration_ms(text: Column) -> Column:
    """'12ms', '1.2s', '3m', '2h' in milliseconds; the first unit that occurs in that order counts, others give null."""
    number = lambda unit: F.trim(F.replace(text, F.lit(unit), F.lit(""))).try_cast("double")
    return (
        F.when(text.contains("ms"), number("ms"))
        .when(text.contains("s"), number("s") * 1000)
        .when(text.contains("m"), number("m") * 60_000)
        .when(text.contains("h"), number("h") * 3_600_000)
        .otherwise(text.try_cast("double"))
    )


def memory_mb(text: Column) -> Column:
    number = F.regexp_extract(text, r"([0-9.]+)", 1).try_cast("double")
    return F.when(text.contains("GB"), number * 1024).when(text.contains("MB"), number).when(text.contains("KB"), number / 1024).otherwise(number)


def safe_int(text: Column) -> Column:
    """0 where the text is no whole number."""
    return F.coalesce(F.trim(F.replace(text, F.lit("%"), F.lit(""))).try_cast("long"), F.lit(0).cast("long"))


def safe_double(text: Column) -> Column:
    return F.coalesce(F.trim(F.replace(text, F.lit("%"), F.lit(""))).try_cast("double"), F.lit(0.0))


def without_commas(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(""))


def percent_fraction(text: Column) -> Column:
    return F.round(without_commas(text).try_cast("double") / 100, 6)


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "").try_cast("long")


def clamp(value: Column, least: int, most: int) -> Column:
    return F.greatest(F.lit(least), F.least(F.lit(most), value))


def process_tail(name: Column) -> Column:
    return F.substring_index(name, ":", -1)


def clean_sample(name: Column) -> Column:
    stem = F.regexp_replace(name, r"\.(tsv|json|txt)$", "")
    return F.regexp_replace(F.regexp_replace(stem, r"\.chopped", ""), r"\.fastp", "")


def snapshot_key(sample: Column, batch: Column) -> Column:
    """krak|sample|batch, 'final' where there is no batch; batch 0 is a batch."""
    return F.concat_ws("|", F.lit("krak"), sample, F.coalesce(batch.cast("string"), F.lit("final")))


def version_string(version: Column, commit: Column) -> Column:
    return F.concat(F.when(version.startswith("v"), version).otherwise(F.concat(F.lit("v"), version)), F.when(commit.isNotNull(), F.concat(F.lit("-g"), F.substring(commit, 1, 7))).otherwise(F.lit("")))


def paf_tag(tags: Column, prefix: str) -> Column:
    """The number of the first tag that starts with the prefix, such as dv:f:."""
    return F.get(F.filter(tags, lambda t: t.startswith(prefix)), 0).substr(F.lit(len(prefix) + 1), F.lit(64)).try_cast("double")


def indent(name: Column) -> Column:
    return F.length(name) - F.length(F.ltrim(name))
