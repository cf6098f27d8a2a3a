"""Reads: quality and length filters, trimming, base composition, read-set and assembly summaries."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluvia.sources.staging import staged

from .windows import half_mass


@dataclass(frozen=True)
class ReadFilter:
    """A tool's settings; keep_percent: the share of bases the best reads may make up; cut_quality: the least mean quality
    of a window at a read's ends (both for the tools that have them)."""

    min_quality: float = 10.0
    min_length: int = 1000
    max_length: int | None = None
    headcrop: int = 0
    tailcrop: int = 0
    tool: str = "chopper"
    keep_percent: float | None = None
    cut_quality: float | None = None


#: Bundles of parameters by name.
PRESETS = {
    "strict": ReadFilter(10.0, 2000, keep_percent=75),
    "balanced": ReadFilter(8.0, 1000, keep_percent=90),
    "permissive": ReadFilter(6.0, 500, keep_percent=95),
    "metagenomics": ReadFilter(9.0, 1000, keep_percent=85),
    "assembly": ReadFilter(9.0, 1500, keep_percent=80),
    "rna": ReadFilter(10.0, 500, tool="fastp", cut_quality=15),
    "legacy": ReadFilter(15.0, 1000, tool="fastp", cut_quality=20),
}


def phred(quality: Column) -> Column:
    """Scores of a quality string (offset 33)."""
    return F.transform(F.filter(F.split(quality, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)


_ERRORS = np.array([10.0 ** (q / -10.0) for q in range(-33, 223)])


def mean_quality(quality: Column) -> Column:
    """The score of the mean error probability, which is summed up from the first letter to the last."""

    @F.pandas_udf("double")
    def expected(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            if text:
                own = _ERRORS[np.frombuffer(text.encode("latin-1"), np.uint8)] if text.isascii() else 10.0 ** ((np.array([ord(c) for c in text]) - 33) / -10.0)
                out[i] = np.cumsum(own)[-1]
        return pd.Series(out)

    n = F.length(quality)
    return F.when(n > 0, -10 * F.log10(expected(quality) / n))


def arithmetic_quality(quality: Column) -> Column:
    return F.when(F.length(quality) > 0, F.aggregate(phred(quality), F.lit(0).cast("long"), lambda a, q: a + q) / F.length(quality))


def crop(reads: DataFrame, head: int, tail: int) -> DataFrame:
    cut = lambda c: F.substring(F.col(c), head + 1, F.greatest(F.lit(0), F.length(c) - head - tail))
    return reads.withColumns({c: cut(c) for c in ("sequence", "quality")}) if head or tail else reads


def filter_reads(reads: DataFrame, f: ReadFilter = ReadFilter(), quality: Column | None = None) -> DataFrame:
    """Reads of the given length and mean quality, then cropped. The cheap length test comes first."""
    n = F.length("sequence")
    kept = reads.filter((n >= f.min_length) & (n <= f.max_length if f.max_length is not None else F.lit(True)))
    if f.min_quality > 0:
        kept = kept.filter((quality if quality is not None else mean_quality(F.col("quality"))) >= f.min_quality)
    return crop(kept, f.headcrop, f.tailcrop)


def keep_best_reads(reads: DataFrame, keys: list[str], percent: float | None = 90, target: int | None = None, min_length: int = 1000, columns: list[str] | None = None) -> DataFrame:
    """The longest reads that make up the share of bases (ties by id). columns: those of the result (all, if not given);
    they are staged, so that what the reads are made of runs once.

    The windows run over lengths and their counts; only reads of the one length at which the share is reached are ranked.
    """
    columns = columns or reads.columns
    n = reads.withColumn("_len", F.length("sequence")).filter(F.col("_len") >= min_length)
    n = staged(n.select(*dict.fromkeys([*columns, *keys, "read_id"]), "_len"), "reads")
    w = Window.partitionBy(*keys).orderBy(F.desc("_len"))
    bases = F.col("_len") * F.col("_c")
    sizes = n.groupBy(*keys, "_len").agg(F.count("*").alias("_c")).select(*keys, "_len", "_c", F.coalesce(F.sum(bases).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum(bases).over(Window.partitionBy(*keys)).alias("_all"))
    # The i-th read of a length (from 0) stays while before + i * length is below each bound.
    left = [F.col("_all") * F.lit(percent) / 100 - F.col("_before")] if percent is not None else []
    left += [F.lit(float(target)) - F.col("_before")] if target is not None else []
    most = F.ceil(F.least(*left, F.lit(float("inf"))) / F.col("_len")) if left else F.col("_c")
    taken = sizes.select(*keys, "_len", "_c", F.greatest(F.lit(0), F.least("_c", most)).cast("long").alias("_take")).filter("_take > 0")
    own = n.join(taken, [*keys, "_len"])
    part = own.filter("_take < _c").withColumn("_i", F.row_number().over(Window.partitionBy(*keys, "_len").orderBy("read_id"))).filter("_i <= _take")
    return own.filter("_take = _c").select(columns).unionByName(part.select(columns))


def cut_ends(reads: DataFrame, quality: float, window: int = 4) -> DataFrame:
    """Cut reads at both ends up to the first and the last window of `window` letters whose mean score reaches `quality`.
    A read without such a window is cut to nothing; one shorter than the window is a window of its own.

    Windows are told from prefix sums of the scores, over Arrow batches: a built-in expression would sum anew at each place.
    """

    @F.pandas_udf("start int, size int")
    def kept(text: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(text), 2), np.int32)
        for i, x in enumerate(text):
            if x:
                q = np.frombuffer(x.encode("latin-1", "replace"), np.uint8).astype(np.int64) - 33
                w = min(window, len(q))
                sums = np.append(0, np.cumsum(q))
                good = np.flatnonzero(sums[w:] - sums[:-w] >= w * quality)
                if len(good):
                    out[i] = good[0] + 1, good[-1] + w - good[0]
        return pd.DataFrame(out, columns=["start", "size"])

    out = reads.withColumn("_kept", kept("quality"))
    return out.withColumns({c: F.substring(c, F.col("_kept.start"), F.col("_kept.size")) for c in ("sequence", "quality")}).drop("_kept")


def apply_preset(reads: DataFrame, keys: list[str], f: ReadFilter | str, columns: list[str] | None = None) -> DataFrame:
    """All that a preset asks for, in its tool's order: ends cut by quality, reads filtered by length and mean quality,
    and of each key's the best that make up keep_percent of the bases. columns: those of the result (all, if not given)."""
    f = PRESETS[f] if isinstance(f, str) else f
    if f.tool == "fastp" and f.cut_quality is not None:
        reads = cut_ends(reads, f.cut_quality)
    kept = filter_reads(reads, f)
    if f.keep_percent is not None:
        return keep_best_reads(kept, keys, f.keep_percent, min_length=0, columns=columns)
    return kept.select(columns) if columns else kept


def base_count(sequence: Column, bases: str) -> Column:
    return F.length(sequence) - F.length(F.translate(sequence, bases, ""))


def gc_fraction(contigs: DataFrame, keys: list[str]) -> DataFrame:
    """GC of all bases that are A, C, G or T, any case; keys without such bases are left out."""
    s = F.col("sequence")
    out = contigs.groupBy(*keys).agg(F.sum(base_count(s, "GCgc")).alias("gc"), F.sum(base_count(s, "ACGTacgt")).alias("acgt"))
    return out.filter("acgt > 0").select(*keys, "gc", "acgt", (F.col("gc") / F.col("acgt")).alias("gc_fraction"))


def contig_gc(contigs: DataFrame, keys: list[str]) -> DataFrame:
    """gc, acgt and gc_fraction of each contig; null where it has none of these bases."""
    s = F.col("sequence")
    gc, acgt = base_count(s, "GCgc").cast("long"), base_count(s, "ACGTacgt").cast("long")
    return contigs.select(*keys, gc.alias("gc"), acgt.alias("acgt"), F.try_divide(gc.cast("double"), acgt).alias("gc_fraction"))


def quality_stats(reads: DataFrame, keys: list[str]) -> DataFrame:
    """Bases of at least Q20 and Q30 (offset 33), N, gaps and GC, and the shares in percent."""
    s, q = F.col("sequence"), F.col("quality")
    counts = {"q20_bases": F.regexp_count(q, F.lit("[5-~]")), "q30_bases": F.regexp_count(q, F.lit("[?-~]")), "sum_n": base_count(s, "Nn"), "sum_gap": base_count(s, ". -"), "gc_bases": base_count(s, "GCgc")}
    out = reads.groupBy(*keys).agg(*(F.sum(c).alias(k) for k, c in counts.items()), F.sum(F.length(q)).alias("_q"), F.sum(F.length(s)).alias("_s"))
    share = lambda a, b: F.try_divide((F.col(a) * 100).cast("double"), F.col(b))
    return out.select(*keys, *counts, share("q20_bases", "_q").alias("q20"), share("q30_bases", "_q").alias("q30"), share("gc_bases", "_s").alias("gc"))


def assembly_summary(contigs: DataFrame, keys: list[str]) -> DataFrame:
    """Contigs (length, circular) of each key: number, total, longest, circular ones, N50 and L50."""
    agg = contigs.groupBy(*keys).agg(F.count("*").alias("total_contigs"), F.sum("length").alias("total_length"), F.max("length").alias("longest"), F.count_if("circular").alias("circular_contigs"))
    return agg.join(half_mass(contigs, keys), keys, "left")


def fastp_verdict(sequence: Column, quality: Column, length_required: int = 15, qualified: int = 15, unqualified_percent: float = 40.0, n_limit: int = 5) -> Column:
    """passed, or why a read fails: too_short, low_quality, too_many_N."""
    q = phred(quality)
    low = F.size(F.filter(q, lambda x: x < qualified)) * 100.0
    return F.when(F.length(sequence) < length_required, "too_short").when(low > F.size(q) * unqualified_percent, "low_quality").when(base_count(sequence, "Nn") > n_limit, "too_many_N").otherwise("passed")


def trim_adapters(reads: DataFrame, adapters: list[str], least: int = 8) -> DataFrame:
    """Cut an adapter that starts a read or ends it, whole or down to `least` of its inner letters."""
    s = F.col("sequence")
    starts = [a[i:] for a in adapters for i in range(max(1, len(a) - least + 1))]
    ends = [a[: len(a) - i] for a in adapters for i in range(max(1, len(a) - least + 1))]
    head = F.length(F.regexp_extract(s, "^(?:" + "|".join(sorted(set(starts), key=len, reverse=True)) + ")", 0)) if starts else F.lit(0)
    tail = F.length(F.regexp_extract(s, "(?:" + "|".join(sorted(set(ends), key=len, reverse=True)) + ")$", 0)) if ends else F.lit(0)
    out = reads.withColumns({"_head": head, "_tail": tail})
    cut = lambda c: F.substring(c, F.col("_head") + 1, F.greatest(F.lit(0), F.length(c) - F.col("_head") - F.col("_tail")))
    return out.withColumns({"sequence": cut(F.col("sequence")), "quality": cut(F.col("quality"))}).drop("_head", "_tail")


def read_summary(reads: DataFrame, keys: list[str], quality: str = "mean_q", marks: tuple[int, ...] = (5, 7, 10, 12, 15)) -> DataFrame:
    """Mean and median of length, median quality, N50, and the reads above the quality marks."""
    n = reads.withColumn("length", F.length("sequence"))
    agg = n.groupBy(*keys).agg(F.count("*").alias("reads"), F.sum("length").alias("bases"), F.avg("length").alias("mean_length"), F.percentile("length", 0.5).alias("median_length"), F.percentile(quality, 0.5).alias("median_quality"), *(F.count_if(F.col(quality) > m).alias(f"above_q{m}") for m in marks))
    return agg.join(half_mass(n, keys).select(*keys, "n50"), keys, "left")
