"""Mixing sources to target weights by a temperature, realised as budgeted block permutations.

A source's share p of all tokens becomes the weight p**a / sum(p**a). A smaller exponent a flattens the mixture: its
entropy grows, and so do the repetitions of small sources. fit() bisects a in [0, 1] for the greatest a whose entropy
(nats) is at least `entropy` (if no a reaches it, 0), or the smallest a at which no source is repeated more than
`most_repeats` times, or, given both, the smallest a that the limit allows if that is the greater. One aggregate over the
totals evaluates all exponents that the next LEVELS halvings can come to, so that the driver sees sums alone and few jobs.

realise() deals each source's documents to `blocks` blocks by a hash of the document. An epoch visits a source's
blocks in an order hashed from the epoch's number; a source takes whole blocks until its part of the budget, weight *
budget, is met: a block is taken while the tokens before it are under the quota. Without a budget, the least one that
takes every row once is used. Each taken block is a run of rows with
a place in [0, 1), spread evenly over the source's quota, so ordering by place interleaves the sources at their weights.

Defined cases: a null source is a source of its own; a null or empty text has no tokens and is dealt as any other; a
source without any token has weight 0 and is taken once; repeated rows count and are dealt as often as they occur; an
empty table gives no rows. Columns of docs stay; the new ones are _epoch, _block and _place, with as many underscores
before all three as keep them apart from the columns of docs. Draws are broadcast where they are BROADCAST_ROWS at most;
results do not depend on it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, read_table, staged

BLOCKS, ROUNDS, LEVELS, BROADCAST_ROWS = 256, 8, 6, 50_000
#: The production targets: an entropy of 0.95 of the greatest, no source more than twice.
ENTROPY_SHARE, MOST_REPEATS = 0.95, 2.0


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def totals(docs: DataFrame, source_col: str = "source", text_col: str = "text", blocks: int = BLOCKS) -> DataFrame:
    """(source, block, tokens, docs): one aggregate over all rows, combined before the shuffle."""
    tokens, block = n_tokens(F.col(text_col)), block_of(docs, blocks)
    return docs.select(F.col(source_col).alias("source"), block.alias("block"), tokens.alias("tokens")).groupBy("source", "block").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))


def block_of(docs: DataFrame, blocks: int, id_col: str = "doc_id", text_col: str = "text") -> Column:
    return F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(blocks)).cast("int")


def _bisect(lo: float, hi: float, measure, enough) -> float:
    """The greatest value for which enough(measure) holds, where it holds up to some point; lo if nowhere."""
    steps = 1 << LEVELS
    for _ in range(ROUNDS):
        grid = [lo + (hi - lo) * i / steps for i in range(steps + 1)]
        found = measure(grid[1:-1])
        a, b = 0, steps
        while b - a > 1:
            half = (a + b) // 2
            a, b = (half, b) if enough(found[half - 1]) else (a, half)
        lo, hi = grid[a], grid[b]
    return lo


def fit(sources: DataFrame, budget: float | None = None, entropy: float | None = None, most_repeats: float | None = None) -> float:
    """The exponent for the totals (source, tokens). budget: tokens to draw (default: as many as take every row once)."""
    sources = sources.filter("tokens > 0").select((F.col("tokens") / F.lit(1.0)).alias("t"))
    total, n, least, most = sources.agg(F.sum("t"), F.count("*"), F.min("t"), F.max("t")).first()
    if not n:
        return 1.0
    p = F.col("t") / F.lit(total)

    def entropies(grid: list[float]) -> list[float]:
        sums = sources.agg(*(x for a in grid for x in (F.sum(F.pow(p, a)), F.sum(F.pow(p, a) * F.log(p) * a)))).first()
        return [math.log(sums[2 * i]) - sums[2 * i + 1] / sums[2 * i] for i in range(len(grid))]

    def repeats(grid: list[float]) -> list[float]:
        # weight * budget / tokens is the greatest where the tokens are fewest, for any a up to 1
        if budget is None:
            return [(most / least) ** (1 - a) for a in grid]
        sums = sources.agg(*(F.sum(F.pow(p, a)) for a in grid)).first()
        return [(least / total) ** a / s * budget / least for a, s in zip(grid, sums)]

    a = 1.0
    if entropy is not None and entropies([1.0])[0] < entropy:
        a = _bisect(0.0, 1.0, entropies, lambda h: h >= entropy)
    elif entropy is None:
        a = 0.0
    if most_repeats is not None and repeats([a])[0] > most_repeats:
        # repeats fall as a grows: search 1 - a
        b = _bisect(0.0, 1 - a, lambda g: repeats([1 - x for x in g]), lambda r: r <= most_repeats)
        a = 1 - b
    return a


def weights(sources: DataFrame, exponent: float) -> DataFrame:
    """(source, tokens, weight), weights adding up to 1."""
    power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(1.0), F.lit(exponent))).otherwise(0.0)
    powers = sources.select("source", "tokens", power.alias("power"))
    return powers.crossJoin(powers.agg(F.sum("power").alias("all"))).select("source", "tokens", F.coalesce(F.try_divide("power", "all"), F.lit(0.0)).alias("weight"))


def draws(blocks: DataFrame, weighted: DataFrame, budget: float, seed: int = 0) -> DataFrame:
    """(source, block, epoch, place): each block as often as it is drawn. blocks: totals()."""
    last = (F.ceil(F.try_divide(F.col("quota"), F.col("all")) - 1e-9) - 1).cast("int")
    b = blocks.join(weighted.select(F.col("source").alias("_s"), F.col("tokens").alias("all"), (F.col("weight") * budget).alias("quota")), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    b = b.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.greatest(F.coalesce(last, F.lit(0)), F.lit(0)))))
    order = Window.partitionBy("source", "epoch").orderBy(F.xxhash64(F.lit(seed), "epoch", "block"), "block")
    before = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("epoch") * F.col("all")
    b = b.withColumn("before", before)
    b = b.filter((F.col("before") < F.col("quota")) | (F.col("before") + F.col("tokens") <= F.col("quota") * (1 + 1e-9)))
    return b.select("source", "block", "epoch", F.coalesce(F.try_divide(F.col("before").cast("double"), F.greatest("quota", F.col("before") + F.col("tokens"))), F.lit(0.0)).alias("place"))


def mix(docs: DataFrame, budget: float | None = None, entropy_share: float | None = ENTROPY_SHARE, most_repeats: float | None = MOST_REPEATS, source_col: str = "source", text_col: str = "text", blocks: int = BLOCKS, seed: int = 0) -> DataFrame:
    """Rows of docs as often as their blocks are drawn, with fresh(docs, "_epoch", "_block", "_place")."""
    epoch, block, place, of_source, of_block, all_draws, draw = fresh(docs, "_epoch", "_block", "_place", "_s", "_b", "_draws", "_draw")
    per_block = staged(totals(docs, source_col, text_col, blocks), "mix-totals")
    sources = per_block.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    whole = sources.agg(F.sum("tokens"), F.sum((F.col("tokens") > 0).cast("long"))).first()
    target = None if entropy_share is None else entropy_share * math.log(max(1, whole[1] or 0))
    exponent = fit(sources, budget, target, most_repeats)
    weighted = staged(weights(sources, exponent), "mix-weights")
    if budget is None:
        budget = weighted.agg(F.max(F.try_divide(F.col("tokens").cast("double"), "weight"))).first()[0] or 0.0
    drawn = draws(per_block, weighted, float(budget), seed)
    # A source's blocks are apart already, so no key of the join holds more than a block's share of it; what is
    # drawn of a block comes as one row.
    drawn = drawn.groupBy("source", "block").agg(F.sort_array(F.collect_list(F.struct("epoch", "place"))).alias(all_draws)).withColumnsRenamed({"source": of_source, "block": of_block})
    drawn = staged(drawn, "mix-draws")
    if drawn.count() <= BROADCAST_ROWS:
        drawn = F.broadcast(drawn)
    rows = docs.withColumn(block, block_of(docs, blocks, text_col=text_col))
    out = rows.join(drawn, F.col(source_col).eqNullSafe(F.col(of_source)) & (F.col(block) == F.col(of_block)))
    out = out.withColumn(draw, F.explode(all_draws))
    return out.select(*docs.columns, F.col(draw)["epoch"].alias(epoch), block, F.col(draw)["place"].alias(place))


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "source", F.col("_epoch").alias("epoch"), F.col("_block").alias("block"), F.col("_place").alias("place"))
