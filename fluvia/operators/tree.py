"""Taxonomy trees: parents from indentation, clade sums, depth-first order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fluvia.functions.scalars import indent
from fluvia.sources.staging import staged, staged_with


def recover_parents(rows: DataFrame, keys: list[str], row_no: str = "row_no", name: str = "name", taxid: str = "taxid") -> DataFrame:
    """The nearest earlier row of less indentation is a row's parent; null for roots. A taxid that comes again has the
    parent of its first row.

    One window carries the last row seen at each indentation above the deepest, so no pair of rows is joined. The
    indentations that occur, of whatever widths, reach the driver.
    """
    widths = sorted(r[0] for r in rows.select(indent(F.col(name))).distinct().collect())
    marked = rows.withColumn("_indent", indent(F.col(name)))
    w = Window.partitionBy(*keys).orderBy(row_no).rowsBetween(Window.unboundedPreceding, -1)
    last = [F.max(F.when(F.col("_indent") == i, F.struct(F.col(row_no), F.col(taxid)))).over(w) for i in widths[:-1]]
    lower = [F.when(F.col("_indent") > i, x) for i, x in zip(widths, last)]
    parent = F.array_max(F.array(*lower))[taxid] if lower else F.lit(None)
    marked = marked.withColumn("_parent", F.struct(parent.cast(rows.schema[taxid].dataType).alias("taxid")))
    first = F.first("_parent").over(Window.partitionBy(*keys, taxid).orderBy(row_no).rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("parent", first["taxid"]).drop("_indent", "_parent")


def ancestors(taxonomy: DataFrame) -> DataFrame:
    """(taxid, ancestor): each taxon with itself and everything above it. taxonomy: (taxid, parent).

    By pointer doubling: after k rounds the ancestors nearer than 2**k are known, and jumps lead 2**k upwards.
    """
    taxa = staged(taxonomy.select("taxid", "parent").distinct(), "taxa")
    up = taxa.filter("parent is not null and parent <> taxid").select("taxid", F.col("parent").alias("_to"))
    nodes = taxa.select("taxid").unionByName(up.select(F.col("_to").alias("taxid"))).distinct()
    found = staged(nodes.select("taxid", F.col("taxid").alias("ancestor")), "ancestors")
    jump, left = staged_with(up, "jumps", F.lit(True))
    while left:
        new, circles = staged_with(jump.join(found.withColumnRenamed("taxid", "_to"), "_to").select("taxid", "ancestor"), "ancestors", F.col("taxid") == F.col("ancestor"))
        if circles:
            raise ValueError("a taxon is its own ancestor")
        found = found.unionByName(new)
        jump, left = staged_with(jump.join(jump.select(F.col("taxid").alias("_to"), F.col("_to").alias("_next")), "_to").select("taxid", F.col("_next").alias("_to")), "jumps", F.lit(True))
    return found.join(taxa.select("taxid").distinct(), "taxid", "left_semi")


def clade_counts(direct: DataFrame, taxonomy: DataFrame, keys: list[str], reads: str = "reads") -> DataFrame:
    """(keys, taxid, reads, cumul): reads on the taxon itself and on its whole subtree."""
    up = ancestors(taxonomy)
    sums = direct.join(up, "taxid").groupBy(*keys, F.col("ancestor").alias("taxid")).agg(F.sum(reads).alias("cumul"))
    own = direct.groupBy(*keys, "taxid").agg(F.sum(reads).alias("reads"))
    return sums.join(own, [*keys, "taxid"], "left").select(*keys, "taxid", F.coalesce("reads", F.lit(0)).alias("reads"), "cumul")


def _doubled(state: DataFrame, step) -> DataFrame:
    """Follow the pointers (_key, taxid, to, ...) with twice the stride each round, until none is left or only those that
    run in circles are. step(state, next) makes the columns of the next round from rows joined with `next`, those of
    the row that `to` names (prefixed next_, null where there is no pointer)."""
    state, live = staged_with(state, "tree-places", F.col("to").isNotNull())
    left = None
    while live and live != left:
        left = live
        ahead = state.select("_key", F.col("taxid").alias("to"), *(F.col(c).alias(f"next_{c}") for c in state.columns if c not in ("_key", "taxid")))
        state, live = staged_with(step(state, ahead), "tree-places", F.col("to").isNotNull())
    return state


def depth_first(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, taxid, parent, cumul, ...) with row_no and depth: roots (no parent, own parent, parent missing) and
    siblings by cumul downwards, then taxid as text; rows that no root leads to (a cycle) come last by taxid, without a
    depth.

    No level is walked. A row's place is the sum, along its way to the root, of one and the sizes of the earlier siblings'
    subtrees. Sizes and places are summed by pointer doubling: in round k each row knows what lies within 2**k levels
    of it, so a tree of depth n takes log2(n) rounds, each a join and a grouped sum over the rows.
    """
    key = F.concat_ws("\x01", *keys) if keys else F.lit("")
    base = staged(rows.withColumn("_key", key), "tree")
    known = base.select(F.col("_key").alias("_k"), F.col("taxid").alias("_p")).distinct()
    linked = base.join(known, (F.col("_key") == F.col("_k")) & (F.col("parent") == F.col("_p")) & (F.col("parent") != F.col("taxid")), "left").select("_key", "taxid", F.col("_p").alias("up"), F.coalesce("cumul", F.lit(0)).alias("cumul"))
    links = staged(linked, "tree-links")

    def sizes(state: DataFrame, ahead: DataFrame) -> DataFrame:
        gains = state.filter("to is not null").groupBy("_key", F.col("to").alias("taxid")).agg(F.sum("size").alias("more"))
        return state.join(ahead.select("_key", "to", "next_to"), ["_key", "to"], "left").join(gains, ["_key", "taxid"], "left").select("_key", "taxid", F.col("next_to").alias("to"), (F.col("size") + F.coalesce("more", F.lit(0))).alias("size"))

    def places(state: DataFrame, ahead: DataFrame) -> DataFrame:
        return state.join(ahead, ["_key", "to"], "left").select("_key", "taxid", F.col("next_to").alias("to"), *((F.col(c) + F.coalesce(f"next_{c}", F.lit(0))).alias(c) for c in ("row_no", "depth")))

    sized = _doubled(links.select("_key", "taxid", F.col("up").alias("to"), F.lit(1).cast("long").alias("size")), sizes)
    tree = links.join(sized.filter("to is null").select("_key", "taxid", "size"), ["_key", "taxid"])
    before = Window.partitionBy("_key", "up").orderBy(F.desc("cumul"), "taxid").rowsBetween(Window.unboundedPreceding, -1)
    first = tree.select("_key", "taxid", F.col("up").alias("to"), (1 + F.coalesce(F.sum("size").over(before), F.lit(0))).alias("row_no"), F.col("up").isNotNull().cast("int").alias("depth"))
    placed = _doubled(first, places).select("_key", "taxid", "row_no", "depth")
    lost = links.join(sized.filter("to is not null").select("_key", "taxid"), ["_key", "taxid"], "left_semi").select("_key", "taxid")
    n = placed.groupBy("_key").agg(F.count("*").alias("n"))
    last = lost.join(n, "_key", "left").select("_key", "taxid", (F.coalesce("n", F.lit(0)) + F.row_number().over(Window.partitionBy("_key").orderBy("taxid"))).alias("row_no"), F.lit(None).cast("int").alias("depth"))
    return base.join(placed.unionByName(last), ["_key", "taxid"]).select(*rows.columns, "depth", F.col("row_no").cast("int").alias("row_no"))


def indented(rows: DataFrame) -> DataFrame:
    return rows.withColumn("name", F.concat(F.repeat(F.lit("  "), F.coalesce(F.col("depth"), F.lit(0))), F.col("name")))


def merge_batches(rows: DataFrame, batch: str = "batch_id", row_no: str = "row_no") -> DataFrame:
    """Cumulative taxa of each sample over its batches: sums of reads and cumul, rank and name as first seen, the first
    known parent. Recomputed from the batch store, so replays change nothing."""
    order = F.struct(batch, row_no)
    return rows.groupBy("sample_id", "taxid").agg(
        F.sum("reads").alias("reads"), F.sum("cumul").alias("cumul"), F.min_by("rank", order).alias("rank"), F.min_by("name", order).alias("name"),
        F.min_by("parent", F.when(F.col("parent").isNotNull(), order)).alias("parent"),
    )


def percents(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """pct of a sample's total; where the total is 0, of its roots' and unclassified clades; 0 where that is 0 too."""
    fallback = rows.groupBy("sample_id").agg(F.sum(F.when(F.col("rank").isin("R", "U"), F.col("cumul")).otherwise(0)).alias("_fallback"))
    out = rows.join(totals.select("sample_id", "total"), "sample_id", "left").join(fallback, "sample_id")
    base = F.coalesce(F.nullif("total", F.lit(0)), F.nullif("_fallback", F.lit(0)))
    return out.withColumn("pct", F.coalesce(F.col("cumul") * 100.0 / base, F.lit(0.0))).drop("total", "_fallback")
