"""k-mer classification: a read's k-mers vote for taxa, the best root-to-leaf path of the taxonomy wins.

The k-mer table (kmer, taxid) holds the lowest common ancestor of the genomes with the k-mer. A minimizer table (minimizer,
taxid) is the smaller one for long k: neighbouring k-mers share their least l-mer, so a read asks for a few minimizers only.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fluvia.sources.staging import staged

from .tree import ancestors

#: Rows of a table that is sent to all executors, and letters that are searched at once for minimizers.
_FEW, _LETTERS = 1 << 18, 1 << 20

_BASES = np.full(256, 4, np.uint8)
for _i, _b in enumerate("ACGT"):
    _BASES[ord(_b)] = _BASES[ord(_b.lower())] = _i


def kmers(sequence: Column, k: int) -> Column:
    """All k-mers of A, C, G and T, in order and with repeats."""
    n = F.length(sequence)
    found = F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.upper(F.substring(sequence, i, F.lit(k))))
    return F.when(n >= k, F.filter(found, lambda x: ~x.rlike("[^ACGT]"))).otherwise(F.array().cast("array<string>"))


def counted_kmers(sequence: Column, k: int) -> Column:
    """An array of (kmer, n): the distinct k-mers of kmers(); null has none."""
    good = re.compile("[ACGTacgt]*")

    @F.arrow_udf("array<struct<kmer: string, n: int>>")
    def found(texts: pa.Array) -> pa.Array:
        names, counts, ends = [], [], [0]
        for text in texts.to_pylist():
            text = text or ""
            n = Counter(text[i : i + k].upper() for m in good.finditer(text) for i in range(m.start(), m.end() - k + 1))
            names += n.keys()
            counts += n.values()
            ends.append(len(names))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int32())], ["kmer", "n"]))

    return found(sequence)


@dataclass(frozen=True)
class Minimizers:
    """k-mers of k letters, minimizers of l (31 at most). Of an l-mer's letters `spaces` do not count: every second one from the
    last but one on. Codes are compared after an exclusive or with `toggle`, so that runs of A are not the least."""

    k: int = 35
    l: int = 31  # noqa: E741
    spaces: int = 7
    toggle: int = 0xE37E28C4271B5A2D

    def __post_init__(self):
        if not 1 <= self.l <= min(self.k, 31) or self.spaces < 0 or 2 * self.spaces > self.l - 1:
            raise ValueError("l is from 1 to k and to 31, with spaces under half of it")

    @property
    def all_bits(self) -> int:
        return (1 << 2 * self.l) - 1

    @property
    def mask(self) -> int:
        return self.all_bits & ~sum(3 << (2 + 4 * i) for i in range(self.spaces))

    def codes(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Each k-mer's minimizer, and whether all its letters are A, C, G or T in any case. An l-mer counts as the lesser of
        itself and its reverse complement."""
        b = _BASES[np.frombuffer(text.encode("ascii", "replace"), np.uint8)]
        n, many = len(b) - self.l + 1, len(b) - self.k + 1
        if many < 1:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        there, back, v = np.zeros(n, np.uint64), np.zeros(n, np.uint64), (b & 3).astype(np.uint64)
        two = np.uint64(2)
        for i in range(self.l):
            there = there << two | v[i : i + n]
            back |= (np.uint64(3) - v[i : i + n]) << np.uint64(2 * i)
        least = (np.minimum(there, back) & np.uint64(self.mask)) ^ np.uint64(self.toggle & self.mask)
        # Doubled windows: after a step the minimum covers `w` l-mers; two that overlap cover the k-mer.
        w, wanted = 1, self.k - self.l + 1
        while w * 2 <= wanted:
            least, w = np.minimum(least[: len(least) - w], least[w:]), w * 2
        if w < wanted:
            least = np.minimum(least[:many], least[wanted - w : wanted - w + many])
        bad = np.append(0, np.cumsum(b > 3))
        return least[:many], bad[self.k :] == bad[: -self.k]


def minimizers(sequence: Column, m: Minimizers) -> Column:
    """An array of (minimizer, n, groups): the k-mers with the minimizer, and the runs that they make up. null and texts
    under k letters have none."""

    def counted(texts: list[str]) -> pa.Array:
        """Of texts joined by a break: no k-mer with it counts, so no run goes on in the next text."""
        codes, good = m.codes("\n".join(texts))
        at = np.flatnonzero(good)
        codes = codes[at].astype(np.int64)
        text = np.searchsorted(np.cumsum([len(x) + 1 for x in texts]), at, "right")
        starts = np.append(True, (codes[1:] != codes[:-1]) | (np.diff(at) > 1))[: len(at)]
        order = np.lexsort((codes, text))
        codes, text = codes[order], text[order]
        first = np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]) | (text[1:] != text[:-1]))[: len(at)])
        n, groups = np.diff(np.append(first, len(at))), np.add.reduceat(starts[order].astype(np.int64), first) if len(at) else first
        ends = np.append(0, np.cumsum(np.bincount(text[first], minlength=len(texts))))
        values = [pa.array(codes[first]), pa.array(n, pa.int32()), pa.array(groups, pa.int32())]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(values, ["minimizer", "n", "groups"]))

    @F.arrow_udf("array<struct<minimizer: bigint, n: int, groups: int>>")
    def found(texts: pa.Array) -> pa.Array:
        own, out, size = [], [], 0
        for text in texts.to_pylist():
            own.append(text or "")
            size += len(own[-1])
            if size >= _LETTERS:
                out.append(counted(own))
                own, size = [], 0
        return pa.concat_arrays([*out, counted(own)] if own or not out else out)

    return found(sequence)


def lowest_common(pairs: DataFrame, taxonomy: DataFrame, key: str) -> DataFrame:
    """(key, taxid) from distinct pairs: the deepest taxon above all of a key's taxa."""
    up = _with_depth(taxonomy)
    depth = up.filter("taxid = ancestor").select("ancestor", "depth")
    many = pairs.groupBy(key).agg(F.count("*").alias("n"))
    shared = looked_up(pairs, up.drop("depth"), "taxid").groupBy(key, "ancestor").agg(F.count("*").alias("m")).join(many.hint("merge"), key).filter("m = n")
    return looked_up(shared, depth, "ancestor").groupBy(key).agg(F.max_by("ancestor", "depth").alias("taxid"))


def _with_depth(taxonomy: DataFrame) -> DataFrame:
    """(taxid, ancestor, depth): ancestors() with the depth of the taxon."""
    return staged(ancestors(taxonomy).withColumn("depth", F.count("*").over(Window.partitionBy("taxid"))), "ancestors")


def looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """rows joined with a table. rows grow with the reads or the genomes, whatever their files' size makes Spark expect: a table
    of few rows goes to them, no other is broadcast, and they never are."""
    few = table.limit(_FEW + 1).count() <= _FEW
    return rows.join(F.broadcast(table) if few else table.hint("merge"), key)


def build_table(genomes: DataFrame, taxonomy: DataFrame, k: int) -> DataFrame:
    """(kmer, taxid) from genomes (taxid, sequence): the deepest taxon above all genomes that have the k-mer."""
    pairs = genomes.select("taxid", F.explode(F.array_distinct(kmers(F.col("sequence"), k))).alias("kmer")).distinct()
    return staged(lowest_common(staged(pairs, "pairs"), taxonomy, "kmer"), "kmers")


def build_minimizer_table(genomes: DataFrame, taxonomy: DataFrame, m: Minimizers = Minimizers(), piece: int = 1 << 16) -> DataFrame:
    """(minimizer, taxid) from genomes (taxid, sequence). Genomes are cut into pieces that share k - 1 letters, so that a
    long one is not one row of Python objects."""
    s = F.col("sequence")
    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1)), F.lit(piece)), lambda i: F.substring(s, i, F.lit(piece + m.k - 1)))
    pieces = genomes.filter(s.isNotNull()).select("taxid", F.explode(cut).alias("sequence"))
    pairs = pieces.select("taxid", F.explode(minimizers(s, m)).alias("x")).select("taxid", "x.minimizer").distinct()
    return staged(lowest_common(staged(pairs, "pairs"), taxonomy, "minimizer"), "minimizers")


def store_table(table: DataFrame, name: str, buckets: int) -> DataFrame:
    """Write a minimizer table to the warehouse in buckets of the minimizer, so that classify_minimizers() does not shuffle it."""
    table.repartition(buckets, "minimizer").write.mode("overwrite").bucketBy(buckets, "minimizer").sortBy("minimizer").saveAsTable(name)
    return table.sparkSession.table(name)


def classify(reads: DataFrame, table: DataFrame, taxonomy: DataFrame, k: int, confidence: float = 0.0, min_hit_groups: int = 0) -> DataFrame:
    """(read_id, status, taxid): C with the taxon whose path has the most k-mer hits (ties to the deeper, then the lesser
    taxid), U with taxid 0 where none is hit, the path's share of k-mers is under confidence, or too few k-mers hit."""
    # A read's k-mers are counted in the read and meet the table before any shuffle where the table is small.
    own = reads.select("read_id", counted_kmers(F.col("sequence"), k).alias("x"))
    own = own.select("read_id", F.aggregate("x", F.lit(0).cast("long"), lambda a, y: a + y["n"]).alias("total"), F.explode("x").alias("x"))
    own = own.select("read_id", "total", F.col("x.kmer").alias("kmer"), F.col("x.n").cast("long").alias("n"), F.lit(1).cast("long").alias("groups"))
    return _best_paths(reads, looked_up(own, table, "kmer"), taxonomy, confidence, min_hit_groups)


def classify_minimizers(reads: DataFrame, table: DataFrame, taxonomy: DataFrame, m: Minimizers = Minimizers(), confidence: float = 0.0, min_hit_groups: int = 0) -> DataFrame:
    """(read_id, status, taxid) as classify(): each k-mer votes with its minimizer's taxon, a run of k-mers with one
    minimizer is a hit group. One row for each distinct minimizer of a read is shuffled."""
    own = reads.select("read_id", minimizers(F.col("sequence"), m).alias("x"))
    own = own.select("read_id", F.aggregate("x", F.lit(0).cast("long"), lambda a, y: a + y["n"]).alias("total"), F.explode("x").alias("x"))
    own = own.select("read_id", "total", F.col("x.minimizer").alias("minimizer"), F.col("x.n").cast("long").alias("n"), F.col("x.groups").cast("long").alias("groups"))
    return _best_paths(reads, looked_up(own, table, "minimizer"), taxonomy, confidence, min_hit_groups)


def _best_paths(reads: DataFrame, hits: DataFrame, taxonomy: DataFrame, confidence: float, min_hit_groups: int) -> DataFrame:
    """hits: (read_id, total, taxid, n, groups). Joins by read are merged: both sides grow with the reads, and what looks small
    as compressed shuffle files would be sent through the driver. Votes are staged, so reads are searched once, and dealt by
    read before the ancestors multiply them; what follows is summed where it lies."""
    up = _with_depth(taxonomy)
    votes = hits.groupBy("read_id", "taxid").agg(F.sum("n").alias("n"), F.sum("groups").alias("groups"), F.max("total").alias("total"))
    votes = staged(looked_up(votes, up.filter("taxid = ancestor").select("taxid", "depth"), "taxid"), "votes")
    sums = votes.groupBy("read_id").agg(F.sum("groups").alias("groups"), F.max("total").alias("total"))
    paths = looked_up(votes.select("read_id", "taxid", "depth", "n").repartition("read_id"), up.drop("depth"), "taxid")
    own = F.sum(F.when(F.col("taxid") == F.col("ancestor"), F.col("n"))).over(Window.partitionBy("read_id", "ancestor"))
    scores = paths.withColumn("_own", own).groupBy("read_id", "taxid", "depth").agg(F.sum("_own").alias("score"))
    order = F.struct(F.negative("score"), F.negative("depth"), F.col("taxid"))
    best = scores.groupBy("read_id").agg(F.min_by(F.struct("taxid", "score"), order).alias("b"))
    good = (F.col("b.score") >= F.col("total") * confidence) & (F.col("groups") >= min_hit_groups)
    out = reads.select("read_id").join(best.hint("merge"), "read_id", "left").join(sums.hint("merge"), "read_id", "left")
    ok = F.coalesce(good, F.lit(False))
    return out.select("read_id", F.when(ok, "C").otherwise("U").alias("status"), F.when(ok, F.col("b.taxid")).otherwise("0").alias("taxid"))


def classify_new(reads: DataFrame, path: str, classified: Callable[[DataFrame], DataFrame], redo: tuple = ()) -> list:
    """Classify the batches of reads (with batch_id) that the store at `path` does not hold, and those in `redo` anew.

    classified: reads -> rows with read_id, which is batch and id here, so that one id may come in several batches. The store has a folder for each batch, put in place when all of the run's rows
    are written, so a batch is there as a whole or not at all, and one that runs again replaces itself. Returns the batches
    done. Batch numbers reach the driver; a reads table with a folder for each batch is read in the new batches only.
    """
    spark = reads.sparkSession
    known = {r[0] for r in stored_verdicts(spark, path).select("batch_id").distinct().collect()} if _exists(spark, path) else set()
    todo = sorted({r[0] for r in reads.select("batch_id").filter("batch_id is not null").distinct().collect()} - (known - set(redo)))
    if todo:
        own = reads.filter(F.col("batch_id").isin(todo)).withColumn("read_id", F.struct("batch_id", "read_id"))
        found = classified(own)
        out = found.select(*(F.col("read_id")[c].alias(c) for c in ("read_id", "batch_id")), *(c for c in found.columns if c != "read_id"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)
    return todo


def stored_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """All batches of classify_new(), with batch_id as a long."""
    rows = spark.read.parquet(path)
    return rows.withColumn("batch_id", F.col("batch_id").cast("long"))


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(at) and any(x.isDirectory() and x.getPath().getName().startswith("batch_id=") for x in files.listStatus(at))
