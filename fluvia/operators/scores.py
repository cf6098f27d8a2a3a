"""Scores of reads by length, mean quality and worst window, and the best reads up to a share or a number of bases."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluvia.sources.staging import staged

from .aggregates import read_set_stats
from .reads import quality_stats
from .windows import half_mass

#: Error probabilities are whole numbers of 10**-12, so that sums do not depend on their order.
UNIT = 10**12
_ERRORS = np.array([min(UNIT, round(UNIT * 10 ** (-q / 10))) for q in range(-33, 223)], np.int64)


def errors(quality: Column, window: int = 250) -> Column:
    """(total, worst) of a quality string (offset 33): expected errors, all and in the worst `window` letters (a shorter read
    is a window of its own), in units of 10**-12; null and empty have none."""

    @F.pandas_udf("total bigint, worst bigint")
    def summed(texts: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(texts), 2), np.int64)
        for i, text in enumerate(texts):
            if text:
                sums = np.append(0, np.cumsum(_ERRORS[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)]))
                w = min(window, len(sums) - 1)
                out[i] = sums[-1], (sums[w:] - sums[:-w]).max()
        return pd.DataFrame(out, columns=["total", "worst"])

    return summed(quality)


def scored(reads: DataFrame, window: int = 250, half_length: int = 5000) -> DataFrame:
    """Reads with mean_q and window_q (100 times the share of right letters, in all and in the worst window) and score: the
    geometric mean of mean_q and the length's score (50 at half_length letters), times window_q / mean_q."""
    n = F.length("quality")
    right = lambda c, size: F.coalesce(F.lit(100.0) - F.try_divide(F.col(c).cast("double"), size.cast("double")) / F.lit(UNIT / 100), F.lit(0.0))
    out = reads.withColumn("_e", errors(F.col("quality"), window)).withColumns({"mean_q": right("_e.total", n), "window_q": right("_e.worst", F.least(n, F.lit(window)))})
    size = F.lit(100.0) * F.length("sequence") / (F.length("sequence") + F.lit(half_length))
    score = F.sqrt(size * F.col("mean_q")) * F.try_divide(F.col("window_q"), F.col("mean_q"))
    return out.withColumn("score", F.coalesce(score, F.lit(0.0))).drop("_e")


def keep_best(rows: DataFrame, keys: list[str], percent: float | None = None, target: int | None = None, min_length: int = 0, max_length: int | None = None, min_mean_q: float = 0, min_window_q: float = 0, columns: list[str] | None = None) -> DataFrame:
    """Of scored() reads within the limits, each key's best (ties by id) while those before have fewer bases than the
    share of the key's bases and than the target. columns: those of the result (all, if not given); they are staged, so
    that the reads are scored once.

    Bases are summed over thousandths of the score; only reads of the one thousandth at which a bound is reached are ranked.
    """
    n = F.length("sequence")
    within = (n >= min_length) & (F.col("mean_q") >= min_mean_q) & (F.col("window_q") >= min_window_q)
    own = rows.filter(within & (n <= max_length if max_length is not None else F.lit(True))).withColumns({"_n": n.cast("long"), "_grade": F.floor(F.col("score") * 1000)})
    columns = columns or rows.columns
    own = staged(own.select(*dict.fromkeys([*columns, *keys, "read_id", "score"]), "_n", "_grade"), "scored")
    before = Window.partitionBy(*keys).orderBy(F.desc("_grade")).rowsBetween(Window.unboundedPreceding, -1)
    grades = own.groupBy(*keys, "_grade").agg(F.sum("_n").alias("_sum"))
    grades = grades.select("*", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"), F.sum("_sum").over(Window.partitionBy(*keys)).alias("_all"))
    bounds = [F.lit(float(target))] if target is not None else []
    bounds += [F.col("_all") * F.lit(float(percent)) / 100] if percent is not None else []
    bound = F.least(*bounds, F.lit(float("inf"))) if bounds else F.lit(float("inf"))
    grades = grades.withColumn("_bound", bound).filter("_before < _bound").withColumn("_part", F.col("_before") + F.col("_sum") >= F.col("_bound"))
    met = own.join(grades.select(*(F.col(k).alias(f"_{k}_key") for k in keys), F.col("_grade").alias("_g"), "_before", "_bound", "_part"), [*(F.col(k).eqNullSafe(F.col(f"_{k}_key")) for k in keys), F.col("_grade") == F.col("_g")])
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "read_id").rowsBetween(Window.unboundedPreceding, -1)
    ranked = met.filter("_part").withColumn("_more", F.coalesce(F.sum("_n").over(w), F.lit(0))).filter("_before + _more < _bound")
    return met.filter("not _part").select(columns).unionByName(ranked.select(columns))


def full_stats(reads: DataFrame, keys: list[str]) -> DataFrame:
    """All statistics of read sets: read_set_stats(), N50 and the reads that reach it, quality_stats(), and avg_qual, the
    score of the mean error probability of all letters (two places; null without letters). Keys are not null."""
    own = reads.withColumns({"length": F.length("sequence"), "_e": errors(F.col("quality"))["total"]})
    mean = F.sum("_e").cast("double") / F.lit(float(UNIT)) / F.sum(F.length("quality"))
    qualities = own.groupBy(*keys).agg(F.when(F.sum(F.length("quality")) > 0, F.round(F.log10(mean) * -10, 2)).alias("avg_qual"))
    half = half_mass(own, keys).select(*keys, "n50", F.col("l50").alias("n50_num"))
    rates = quality_stats(reads, keys).select(*keys, "q20", "q30", "gc", "sum_gap", "sum_n")
    return read_set_stats(reads, keys).join(half, keys, "left").join(rates, keys).join(qualities, keys)
