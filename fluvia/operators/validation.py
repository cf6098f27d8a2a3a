"""Alignment verdicts: which reads to check, hit rates, identity, breadth, and the confirmed / uncertain / rejected rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import covered, first_per_key, interval_islands


@dataclass(frozen=True)
class Thresholds:
    hit_rate: float = 0.5
    identity: float = 90.0
    min_reads: int = 10
    min_breadth: float = 0.05
    #: A narrow but deep pile counts as evidence too.
    narrow_breadth: float = 0.05
    narrow_depth: float = 10.0
    narrow_bases: int = 200


def taxid_histogram(assigned: DataFrame) -> DataFrame:
    """(sample_id, taxid, n): classified reads by exact taxid."""
    return assigned.filter("status = 'C'").groupBy("sample_id", "taxid").agg(F.count("*").alias("n"))


def select_genomes(genomes: DataFrame, wanted: str = "auto") -> DataFrame:
    """All genomes for 'auto' or 'all', else those of the comma-separated taxids."""
    if wanted.strip().lower() in ("auto", "all", ""):
        return genomes
    return genomes.filter(F.col("taxid").isin([x.strip() for x in wanted.split(",") if x.strip()]))


def gated_tasks(histogram: DataFrame, genomes: DataFrame, floor: int = 1, unreadable: DataFrame | None = None) -> DataFrame:
    """(sample_id, taxid, path, n): genomes with at least max(1, floor) reads of the sample.

    An equi-join on taxid in place of samples x genomes. Samples without a readable histogram (unreadable: sample_id)
    fail open: they get every genome, with n null.
    """
    out = histogram.filter(F.col("n") >= max(1, floor)).join(genomes, "taxid").select("sample_id", "taxid", "path", "n")
    if unreadable is not None:
        # Few samples are unreadable; their genomes are dealt by taxid, not gathered under one key.
        every = genomes.select("taxid", "path").crossJoin(unreadable.select("sample_id").distinct())
        out = out.unionByName(every.select("sample_id", "taxid", "path", F.lit(None).cast("long").alias("n")))
    return out


def extract_reads(reads: DataFrame, assigned: DataFrame, taxid: str | None = None) -> DataFrame:
    """Reads whose id is assigned (to the taxid): a semi-join, so a repeated id repeats no read."""
    ids = assigned.filter("status = 'C'")
    if taxid is not None:
        ids = ids.filter(F.col("taxid") == taxid)
    return reads.join(ids.select("read_id"), "read_id", "left_semi")


def extraction_stats(assigned: DataFrame) -> DataFrame:
    """(sample_id, taxid, extracted, classified, rate)."""
    per = taxid_histogram(assigned)
    whole = per.groupBy("sample_id").agg(F.sum("n").alias("classified"))
    return per.join(whole, "sample_id").select("sample_id", "taxid", F.col("n").alias("extracted"), "classified", F.coalesce(F.try_divide(F.col("n").cast("double"), "classified"), F.lit(0.0)).alias("rate"))


def verdict(hit_rate: Column, identity: Column, hits: Column, t: Thresholds = Thresholds(), breadth: Column | None = None, depth: Column | None = None, bases: Column | None = None) -> Column:
    strong = (hit_rate >= t.hit_rate) & (identity >= t.identity) & (hits >= t.min_reads)
    if breadth is not None:
        narrow = (breadth <= t.narrow_breadth) & (depth >= t.narrow_depth) & (bases >= t.narrow_bases)
        strong = strong & ((breadth >= t.min_breadth) | narrow)
    weak = (hit_rate >= t.hit_rate / 2) | (identity >= t.identity * 0.9)
    return F.when(F.coalesce(strong, F.lit(False)), "confirmed").when(F.coalesce(weak, F.lit(False)), "uncertain").otherwise("rejected")


def hit_stats(hits: DataFrame, totals: DataFrame, keys: list[str], order: list[str], identity: str = "identity") -> DataFrame:
    """(keys, total_reads, hits, hit_rate, avg_identity): one hit per query, the first by order; keys without a hit stay."""
    best = first_per_key(hits, [*keys, "qname"], order)
    agg = best.groupBy(*keys).agg(F.count("*").alias("hits"), F.avg(identity).alias("avg_identity"))
    out = totals.join(agg, keys, "left")
    hit = F.coalesce("hits", F.lit(0))
    return out.select(*keys, "total_reads", hit.alias("hits"), F.coalesce(F.try_divide(hit.cast("double"), "total_reads"), F.lit(0.0)).alias("hit_rate"), F.coalesce("avg_identity", F.lit(0.0)).alias("avg_identity"))


def hit_details(hits: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of one hit per query: number, mean mapping quality, share of the contigs' bases, and the longest contig (ties to
    the first name)."""
    best = first_per_key(hits, [*keys, "qname"], order)
    n = F.count("*")
    return best.groupBy(*keys).agg(
        n.alias("hits"), (F.sum("mapq").cast("double") / n).alias("avg_mapq"), (F.sum(F.col("tend") - F.col("tstart")).cast("double") / F.sum("tlen")).alias("target_coverage"),
        F.min_by("tname", F.struct(-F.col("tlen"), F.col("tname"))).alias("contig"), F.max("tlen").alias("contig_length"),
    )


def mapping_stats(paf: DataFrame, totals: DataFrame, keys: list[str], order: list[str], min_mapq: int = 10, t: Thresholds = Thresholds()) -> DataFrame:
    """All figures of a mapping verdict, from rows (keys, qname, qlen, qstart, qend, tname, tlen, tstart, tend, mapq,
    identity): total_reads, hits, hit_rate, avg_mapq, avg_identity, avg_coverage, covered, aligned, breadth, depth, contig,
    contig_length, status. totals: (keys, total_reads); keys without a row stay.

    A query's hit is its first row by `order` of those of min_mapq; its coverage is of its own length, whichever way it
    lies. Intervals count for all rows of min_mapq that lie in their contig. contig is the longest of all rows, of any
    mapq, of equal ones the first by `order`; 'unknown' without rows. Rows are read once for the sums of a key and once
    for its hits, each as a combined aggregate; no window holds a key.
    """
    good = F.col("mapq") >= min_mapq
    inside = good & (F.col("tend") > F.col("tstart")) & (F.col("tend") <= F.col("tlen"))
    span, size = F.abs(F.col("qend") - F.col("qstart")).cast("double"), F.nullif(F.greatest("qlen", F.lit(0)), F.lit(0))
    whole = paf.groupBy(*keys).agg(
        F.sum(F.when(inside, F.col("tend") - F.col("tstart"))).alias("_aligned"), F.max("tlen").alias("_length"), F.min_by("tname", F.struct((-F.col("tlen")).alias("_n"), *order)).alias("_contig"),
    )
    best = paf.filter(good).groupBy(*keys, "qname").agg(F.min_by(F.struct("mapq", "identity", (span / size).alias("coverage")), F.struct(*order)).alias("_b"))
    hits = best.groupBy(*keys).agg(F.count("*").alias("_hits"), *(F.avg(f"_b.{c}").alias(f"_{c}") for c in ("mapq", "identity", "coverage")))
    islands = interval_islands(paf.filter(inside), keys).groupBy(*keys).agg(F.sum(F.col("hi") - F.col("lo")).alias("_covered"))
    out = totals.join(whole, keys, "left").join(hits, keys, "left").join(islands, keys, "left")
    n = lambda c: F.coalesce(c, F.lit(0))
    share = lambda a, b: F.coalesce(F.try_divide(n(a).cast("double"), b), F.lit(0.0))
    out = out.select(
        *keys, "total_reads", n("_hits").alias("hits"), share("_hits", F.col("total_reads")).alias("hit_rate"), *(F.coalesce(f"_{c}", F.lit(0.0)).alias(f"avg_{c}") for c in ("mapq", "identity", "coverage")),
        n("_covered").alias("covered"), n("_aligned").alias("aligned"), share("_covered", F.col("_length")).alias("breadth"), share("_aligned", F.col("_covered")).alias("depth"),
        F.coalesce("_contig", F.lit("unknown")).alias("contig"), n("_length").alias("contig_length"),
    )
    return out.withColumn("status", verdict(F.col("hit_rate"), F.col("avg_identity"), F.col("hits"), t, F.col("breadth"), F.col("depth"), F.col("covered")))


def blast_stats(hits: DataFrame, totals: DataFrame, keys: list[str], order: list[str], t: Thresholds = Thresholds()) -> DataFrame:
    """All figures of a BLAST verdict from rows (keys, qname, identity, qcovs in percent, evalue): total_reads, hits,
    hit_rate, avg_identity, avg_coverage, min_evalue (1 without hits), status. A query counts by its first row by order."""
    best = hits.groupBy(*keys, "qname").agg(F.min_by(F.struct("identity", "qcovs", "evalue"), F.struct(*order)).alias("_b"))
    agg = best.groupBy(*keys).agg(F.count("*").alias("_hits"), F.avg("_b.identity").alias("_identity"), (F.avg("_b.qcovs") / 100.0).alias("_coverage"), F.min("_b.evalue").alias("_evalue"))
    hit = F.coalesce("_hits", F.lit(0))
    out = totals.join(agg, keys, "left").select(
        *keys, "total_reads", hit.alias("hits"), F.coalesce(F.try_divide(hit.cast("double"), "total_reads"), F.lit(0.0)).alias("hit_rate"), F.coalesce("_identity", F.lit(0.0)).alias("avg_identity"),
        F.coalesce("_coverage", F.lit(0.0)).alias("avg_coverage"), F.coalesce("_evalue", F.lit(1.0)).alias("min_evalue"),
    )
    return out.withColumn("status", verdict(F.col("hit_rate"), F.col("avg_identity"), F.col("hits"), t))


def alignment_stats(paf: DataFrame, totals: DataFrame, keys: list[str], order: list[str], min_mapq: int = 10) -> DataFrame:
    """hit_stats over alignments of at least min_mapq, with breadth, local depth and covered bases.

    Contigs are pooled; breadth divides by the longest contig seen at any mapq.
    """
    passed = paf.filter(F.col("mapq") >= min_mapq)
    stats = hit_stats(passed, totals, keys, order)
    spans = covered(passed.filter("tend > tstart and tend <= tlen"), keys)
    longest = paf.groupBy(*keys).agg(F.max("tlen").alias("contig"))
    out = stats.join(spans, keys, "left").join(longest, keys, "left")
    bases = F.coalesce("covered", F.lit(0))
    return out.select(*stats.columns, bases.alias("covered"), F.coalesce(F.try_divide(bases.cast("double"), "contig"), F.lit(0.0)).alias("breadth"), F.coalesce(F.try_divide(F.col("aligned").cast("double"), "covered"), F.lit(0.0)).alias("depth"))


def alignment_verdicts(paf: DataFrame, totals: DataFrame, keys: list[str], order: list[str], min_mapq: int = 10, t: Thresholds = Thresholds()) -> DataFrame:
    s = alignment_stats(paf, totals, keys, order, min_mapq)
    return s.withColumn("status", verdict(F.col("hit_rate"), F.col("avg_identity"), F.col("hits"), t, F.col("breadth"), F.col("depth"), F.col("covered")))


def blast_verdicts(hits: DataFrame, totals: DataFrame, keys: list[str], order: list[str], t: Thresholds = Thresholds()) -> DataFrame:
    s = hit_stats(hits, totals, keys, order)
    return s.withColumn("status", verdict(F.col("hit_rate"), F.col("avg_identity"), F.col("hits"), t))


def verdicts_by_stage(rows: DataFrame, counted: Column, keys: list[str], stage: str, order: list[str], t: Thresholds = Thresholds()) -> DataFrame:
    """blast_verdicts over the rows so far, at each stage that a key has rows of: (keys, stage, total_reads, hits,
    hit_rate, avg_identity, status). counted: which rows can be hits.

    A query's hit changes at few stages. Each change is carried as differences of (hits, identity) at its stage, and
    sums of these run over a key's stages, so that no row is repeated for later stages.
    """
    own = rows.filter(counted).groupBy(*keys, "qname", stage).agg(F.min(F.struct(*order, F.col("identity").alias("_identity"))).alias("_best"))
    seen = Window.partitionBy(*keys, "qname").orderBy(stage)
    now = own.withColumn("_best", F.min("_best").over(seen.rowsBetween(Window.unboundedPreceding, 0)))
    before = F.lag("_best").over(seen)
    change = now.select(*keys, stage, F.when(before.isNull(), 1).otherwise(0).alias("_hit"), (F.col("_best._identity") - F.coalesce(before["_identity"], F.lit(0.0))).alias("_gain"))
    change = change.groupBy(*keys, stage).agg(F.sum("_hit").alias("_hit"), F.sum("_gain").alias("_gain"))
    so_far = Window.partitionBy(*keys).orderBy(stage).rowsBetween(Window.unboundedPreceding, 0)
    run = lambda c: F.sum(F.coalesce(c, F.lit(0))).over(so_far)
    steps = rows.groupBy(*keys, stage).agg(F.count("*").alias("_rows")).join(change, [*keys, stage], "left")
    s = steps.select(*keys, stage, run("_rows").alias("total_reads"), run("_hit").alias("hits"), run("_gain").alias("_sum"))
    s = s.withColumns({"hit_rate": F.col("hits").cast("double") / F.col("total_reads"), "avg_identity": F.coalesce(F.try_divide("_sum", "hits"), F.lit(0.0))}).drop("_sum")
    return s.withColumn("status", verdict(F.col("hit_rate"), F.col("avg_identity"), F.col("hits"), t))


def merge_methods(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Both methods' verdicts side by side. The first owns the row; where it is missing the second does."""
    a = first.select(*keys, F.struct("hits", "hit_rate", "status").alias("_a"))
    b = second.select(*keys, F.struct("hits", "hit_rate", "status").alias("_b"))
    own = lambda c: F.coalesce(F.col(f"_a.{c}"), F.col(f"_b.{c}"))
    return a.join(b, keys, "full").select(
        *keys, F.when(F.col("_a").isNotNull(), "blast").otherwise("minimap2").alias("method"), own("hits").alias("hits"), own("hit_rate").alias("hit_rate"), own("status").alias("status"),
        F.when(F.col("_a").isNotNull(), F.col("_b.hits")).alias("minimap2_hits"), F.when(F.col("_a").isNotNull(), F.col("_b.status")).alias("minimap2_status"),
    )


def summary(verdicts: DataFrame) -> DataFrame:
    kinds = ("confirmed", "uncertain", "rejected")
    return verdicts.agg(F.count_distinct("sample_id").alias("samples"), F.count("*").alias("pairs"), *(F.count_if(F.col("status") == k).alias(k) for k in kinds))


def species_names(seeds: DataFrame, reports: DataFrame) -> DataFrame:
    """(taxid, species): the seed map's name, else the first species row's of any report; empty names do not count."""
    both = seeds.select("taxid", "name", F.lit(0).alias("p"), F.lit(0).cast("long").alias("row_no")).unionByName(reports.filter("rank = 'S'").select("taxid", F.trim("name").alias("name"), F.lit(1).alias("p"), F.col("row_no").cast("long").alias("row_no")))
    return both.filter("name <> ''").groupBy("taxid").agg(F.min_by("name", F.struct("p", "row_no", "name")).alias("species"))
