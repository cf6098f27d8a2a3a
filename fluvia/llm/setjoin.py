"""Pairs of sets of 64-bit hashes whose Jaccard similarity is p / q or more, none left out, by prefixes and parities.

All sets are put in one order of hashes. The first common hash of two such sets of sizes n is among the first
n - ceil(p n / q) + 1 of each, so sets that share no hash of these prefixes are no pair. At its places i and j it leaves
1 + min(n - 1 - i, m - 1 - j) common hashes at most, which must be p (n + m) / (p + q) or more. The order may be any:
hashes that are frequent in some of the sets come last, the others by value, so that few sets meet at a prefix.

A hash that the sample did not show as frequent may still be of more sets the more there are, and their pairs would grow
with the square. So a set gives its pairs at a hash if these are CROWD or fewer. Sets with more at some hash meet each other
anew, by the prefixes of a second order, from the hash of the fewest of them to that of the most, counted in all of them:
a pair is given where one of the two has few there, and where both have more, both are in the second order.

Of pairs that meet, parities are compared: two sets differ in as many hashes at least as there are bins in which the
parities of their numbers of hashes differ. What passes is left to an exact comparison.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

_ROW = ("h", "g", "block", "node", "n", "i", "c")
#: Pairs that are given out at once.
FLUSH = 1 << 18
#: Pairs that a set gives at a hash in the first order.
CROWD = 32


def prefix(h: np.ndarray, frequent: np.ndarray, ranks: np.ndarray, least: tuple[int, int]) -> np.ndarray:
    """The prefix of a sorted set; frequent hashes (sorted) come after the others, by rank. An empty set has none."""
    n = len(h)
    if not n:
        return h
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
        last = frequent[at] == h
        h = np.concatenate([h[~last], h[last][np.argsort(ranks[at[last]])]])
    return h[: n + least[0] * n // -least[1] + 1]


def parities(h: np.ndarray) -> np.ndarray:
    """The parity of the number of hashes in each bin; the bins are a power of two, 0.8 of the hashes or more, 64 at least."""
    bins = 1 << max(6, int(np.ceil(np.log2(max(1, 0.8 * len(h))))))
    found = np.bincount((h & np.uint64(bins - 1)).astype(np.int64), minlength=bins) & 1
    return np.packbits(found.astype(np.uint8), bitorder="little").view(np.int64)


def differing(a: Column, b: Column) -> Column:
    """The bins in which parities differ; the longer ones are folded to the bins of the shorter."""
    least = F.least(F.size(a), F.size(b))

    def folded(x: Column, i: Column) -> Column:
        return F.aggregate(F.sequence(i, F.size(x) - 1, least), F.lit(0).cast("long"), lambda y, at: y.bitwiseXOR(F.get(x, at)))

    return F.aggregate(F.sequence(F.lit(0), least - 1), F.lit(0), lambda n, i: n + F.bit_count(folded(a, i).bitwiseXOR(folded(b, i))))


def _meeting(limit: int | None, least: tuple[int, int], crowd: int | None = None):
    """For mapInArrow over rows of _ROW sorted by (h, g, c): the pairs (a, b) of different c that may be similar.

    Rows of one block do not meet, unless the block is negative. Rows of an (h, g) over the limit come back as they are,
    and so do rows that are in more than crowd pairs, without the pairs of two such rows.
    """
    p, q = least

    def pairs(columns: list[np.ndarray], ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        """ends: the end of each row's bucket."""
        _, _, block, node, n, i, c = columns
        new = np.flatnonzero((ends[1:] != ends[:-1]) | (c[1:] != c[:-1])) + 1
        sizes = np.diff(np.concatenate([[0], new, [len(c)]]))

        def met() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            rows, other = np.arange(len(c)), np.repeat(np.cumsum(sizes), sizes)
            while True:
                more = other < ends[rows]
                rows, other = rows[more], other[more]
                if not len(rows):
                    return
                left = 1 + np.minimum(n[rows] - 1 - i[rows], n[other] - 1 - i[other])
                may = ((p + q) * left >= p * (n[rows] + n[other])) & ((block[rows] != block[other]) | (block[rows] < 0))
                yield rows[may], other[may]
                other = other + 1

        many = np.zeros(len(c), bool)
        if crowd:
            count = np.zeros(len(c), np.int64)
            for one, two in met():
                count[one] += 1
                count[two] += 1
            many = count > crowd
        nothing, found, size = np.empty((2, 0), np.int64), [], 0
        for one, two in met():
            few = ~(many[one] & many[two])
            found.append(np.array([node[one[few]], node[two[few]]]))
            size += int(few.sum())
            if size > FLUSH:
                yield _batch(*np.concatenate(found, axis=1), [x[:0] for x in columns])
                found, size = [], 0
        yield _batch(*np.concatenate([nothing, *found], axis=1), [x[many] for x in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, over = [], None  # over: the bucket whose rows are given back

        def done(columns: list[np.ndarray], last: bool) -> Iterator[pa.RecordBatch]:
            h, g = columns[:2]
            starts = np.concatenate([[0], np.flatnonzero((h[1:] != h[:-1]) | (g[1:] != g[:-1])) + 1])
            sizes = np.diff(np.concatenate([starts, [len(h)]]))
            large = sizes > limit if limit else np.zeros(len(sizes), bool)
            if over is not None:
                large |= (h[starts] == over[0]) & (g[starts] == over[1])
            whole = np.ones(len(sizes), bool)
            whole[-1] = last
            back = np.repeat(large, sizes)
            if back.any():
                yield _batch(*np.empty((2, 0), np.int64), [x[back] for x in columns])
            ready = np.repeat(whole & ~large & (np.minimum.reduceat(columns[6], starts) < np.maximum.reduceat(columns[6], starts)), sizes)
            kept = sizes[whole & ~large & ready[starts]]
            yield from pairs([x[ready] for x in columns], np.repeat(np.cumsum(kept), kept))
            rest = np.repeat(~whole & ~large, sizes)
            return [x[rest] for x in columns], (h[-1], g[-1]) if large[-1] else None

        def through(last: bool):
            nonlocal held, over
            rest, over = yield from done([np.concatenate(x) for x in zip(*held)], last)
            held = [rest] if len(rest[0]) else []

        for batch in batches:
            if batch.num_rows:
                held.append([np.asarray(x) for x in batch.columns])
                yield from through(False)
                pa.default_memory_pool().release_unused()
        if held:
            yield from through(True)

    return run


def _batch(a: np.ndarray, b: np.ndarray, back: list[np.ndarray]) -> pa.RecordBatch:
    nulls = lambda n: pa.nulls(n, pa.int64())
    found = [pa.concat_arrays([pa.array(x), nulls(len(back[0]))]) for x in (a, b)]
    return pa.RecordBatch.from_arrays([*found, *(pa.concat_arrays([nulls(len(a)), pa.array(x)]) for x in back)], ["a", "b", *_ROW])


def rarest_first(sets: DataFrame, hashes: DataFrame, least: tuple[int, int]) -> DataFrame:
    """(node, n, c, i, h): prefixes of sets (node, n, c) with their hashes (node, h array), the hashes of the fewest sets first.

    Hashes of sets of one c only come before all others; no pair meets at them, so they are counted and not given.
    """
    p, q = least
    each = hashes.join(sets.select("node", "c"), "node").select("node", "c", F.explode("h").alias("h"))
    counts = each.groupBy("h").agg(F.count("*").alias("sets"), F.min("c").alias("one"), F.max("c").alias("two"))
    shared = each.select("node", "h").join(counts.filter("one < two").select("h", "sets"), "h")
    own = Window.partitionBy("node")
    shared = shared.withColumn("at", F.row_number().over(own.orderBy("sets", "h"))).withColumn("k", F.count("*").over(own))
    found = shared.join(sets.select("node", "n", "c"), "node").withColumn("i", F.col("n") - F.col("k") + F.col("at") - 1)
    return found.filter(q * (F.col("n") - F.col("i")) >= p * F.col("n")).select("node", "n", "c", "i", "h")


def meeting(sets: DataFrame, least: tuple[int, int], max_bucket: int = 8192, hashes: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(a, b), a < b, of sets (node, n, prefix, c) of different c that meet at a hash and may be similar by sizes and places.

    hashes gives the (node, h array) of nodes, for the second order; without it there is the first one only. The sets of a
    hash are compared in one task, up to max_bucket; more go to the second order and are dealt into blocks there, of which
    each two meet in a task, so that memory is bounded and no task has a group of any size.
    """
    schema = ", ".join(f"{x} long" for x in ("a", "b", *_ROW))
    zero = F.lit(0).cast("long")

    def met(rows: DataFrame, limit: int | None, crowd: int | None = None) -> DataFrame:
        return rows.select(*(F.col(x).cast("long").alias(x) for x in _ROW)).repartition("h", "g").sortWithinPartitions("h", "g", "c").mapInArrow(_meeting(limit, least, crowd), schema)

    def told(rows: DataFrame, crowd: int | None = None) -> tuple[DataFrame, DataFrame]:
        """The pairs, and the rows that are still to meet."""
        found = staged(met(rows.select("*", zero.alias("g"), (zero - 1).alias("block")), max_bucket, crowd), "setjoin-meeting")
        return found.filter("a is not null").select("a", "b"), found.filter("a is null")

    def sizes(large: DataFrame) -> DataFrame:
        return large.groupBy("h").agg(F.count("*").alias("size"), F.min("c").alias("one"), F.max("c").alias("two")).filter("one < two")

    pairs, large = told(sets.select("node", "n", "c", F.posexplode("prefix").alias("i", "h")), CROWD if hashes else None)
    if hashes and not large.isEmpty():
        crowded = staged(large.join(sizes(large), "h", "left_semi").select("node", "n", "c").distinct(), "setjoin-crowded")
        more, large = told(rarest_first(crowded, staged(hashes(crowded.select("node")), "setjoin-hashes"), least))
        pairs = pairs.unionByName(more)
    if not large.isEmpty():
        blocks = sizes(large).select("h", F.ceil(F.col("size") / max_bucket).alias("blocks"))
        dealt = large.drop("g", "block").join(blocks, "h").withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
        dealt = dealt.withColumn("with", F.explode(F.sequence(zero, F.col("blocks") - 1)))
        g = F.least("own", "with") * F.col("blocks") + F.greatest("own", "with")
        dealt = dealt.select("h", g.alias("g"), F.when(F.col("own") == F.col("with"), -1).otherwise(F.col("own")).alias("block"), "node", "n", "i", "c")
        pairs = pairs.unionByName(met(dealt, None).select("a", "b"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def maybe_similar(pairs: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) of sets (node, n, parity) that may be similar by their parities."""
    p, q = least
    one, two = (sets.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("parity").alias(f"p{x}")) for x in "ab")
    both = pairs.join(one, "a").join(two, "b")
    return both.filter((p + q) * differing(F.col("pa"), F.col("pb")) <= (q - p) * (F.col("na") + F.col("nb"))).select("a", "b")
