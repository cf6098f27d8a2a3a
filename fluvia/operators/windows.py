"""Order-dependent computations as window functions over bounded partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordinal(df: DataFrame, key: str, name: str = "n", width: int = 1024) -> DataFrame:
    """Number the rows from 0 by a whole-number key, without one task that sorts them all: rows are numbered within
    ranges of `width` keys, and only the ranges' counts meet in one window."""
    part = F.floor(F.col(key) / width).cast("long")
    counts = df.groupBy(part.alias("_part")).agg(F.count("*").alias("_c"))
    offset = F.coalesce(F.sum("_c").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("_part", offset.alias("_offset"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1
    return df.withColumn("_part", part).withColumn("_own", own).join(counts, "_part").withColumn(name, (F.col("_own") + F.col("_offset")).cast("long")).drop("_part", "_own", "_offset")


def running_sums(df: DataFrame, key: str, sums: dict[str, Column], width: int = 1024) -> DataFrame:
    """df with sums up to each row by a whole-number key. As in ordinal(), only the ranges' totals meet in one window."""
    df = df.withColumn("_part", F.floor(F.col(key) / width).cast("long"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy("_part").agg(*(F.sum(c).alias(k) for k, c in sums.items()))
    offsets = totals.select("_part", *(F.coalesce(F.sum(k).over(ahead), F.lit(0)).alias(f"_o_{k}") for k in sums))
    own = Window.partitionBy("_part").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    out = df.select("*", *(F.sum(c).over(own).alias(f"_w_{k}") for k, c in sums.items())).join(offsets, "_part")
    return out.select(*(c for c in df.columns if c != "_part"), *((F.col(f"_w_{k}") + F.col(f"_o_{k}")).alias(k) for k in sums))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key, the first by an explicit total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def _merged(spans: DataFrame, keys: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("lo", "hi")
    reach = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("_new", F.when(reach.isNull() | (F.col("lo") > reach), 1).otherwise(0))
    marked = marked.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_island")


def interval_islands(df: DataFrame, keys: list[str], start: str = "tstart", end: str = "tend", width: int = 1 << 14) -> DataFrame:
    """(keys, lo, hi): half-open intervals merged where they overlap or touch.

    Of equal starts the longest is kept before the shuffle, and intervals are merged within ranges of `width` starts
    first, so a key with many intervals is not one task's: only the ranges' islands meet in a window for each key.
    """
    spans = df.groupBy(*keys, F.col(start).alias("lo")).agg(F.max(end).alias("hi"))
    near = _merged(spans.withColumn("_range", F.floor(F.col("lo") / width)), [*keys, "_range"]).drop("_range")
    return _merged(near, keys)


def covered(df: DataFrame, keys: list[str], start: str = "tstart", end: str = "tend") -> DataFrame:
    """(keys, covered, aligned): length of the union of the intervals, and the sum of their lengths."""
    islands = interval_islands(df, keys, start, end).groupBy(*keys).agg(F.sum(F.col("hi") - F.col("lo")).alias("covered"))
    total = df.groupBy(*keys).agg(F.sum(F.col(end) - F.col(start)).alias("aligned"))
    return islands.join(total, keys)


def half_mass(lengths: DataFrame, keys: list[str], length: str = "length") -> DataFrame:
    """(keys, n50, l50): from the longest on, the length and the count at which half of the sum is reached.

    Equal lengths are counted first, so a window holds a key's distinct lengths only. Null where the sum is 0.
    """
    hist = lengths.filter(F.col(length) > 0).groupBy(*keys, F.col(length).alias("_l")).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*keys).orderBy(F.desc("_l"))
    to = w.rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.select(*keys, "_l", "_c", F.sum(F.col("_l") * F.col("_c")).over(to).alias("_cum"), F.sum("_c").over(to).alias("_n"), F.sum(F.col("_l") * F.col("_c")).over(Window.partitionBy(*keys)).alias("_all"))
    hit = hist.filter(F.col("_cum") * 2 >= F.col("_all")).groupBy(*keys).agg(F.max_by(F.struct("_l", "_c", "_cum", "_n", "_all"), "_l").alias("x"))
    short = F.col("x._all") - 2 * (F.col("x._cum") - F.col("x._l") * F.col("x._c"))  # twice what was missing before the last length
    taken = F.ceil(short / (2 * F.col("x._l")))
    return hit.select(*keys, F.col("x._l").alias("n50"), (F.col("x._n") - F.col("x._c") + taken).cast("long").alias("l50"))


def batch_numbers(df: DataFrame, key: str, order: list[str], existing: DataFrame | None = None, name: str = "batch_id") -> DataFrame:
    """0, 1, 2 ... within each key, going on after the greatest number in existing (key, batch_id)."""
    out = df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1)
    if existing is not None:
        top = existing.groupBy(key).agg((F.max("batch_id") + 1).alias("_next"))
        out = out.join(top, key, "left").withColumn("_n", F.col("_n") + F.coalesce("_next", F.lit(0))).drop("_next")
    return out.withColumn(name, F.col("_n").cast("long")).drop("_n")


def every_nth(df: DataFrame, ordinal_col: str, interval: int) -> DataFrame:
    return df.filter(F.col(ordinal_col) % interval == 0)


def round_robin(df: DataFrame, group: str, name: str, place: str = "place") -> DataFrame:
    """(turn, group order) by which groups take turns: a row's rank in its group by name, then the group's first name."""
    w = Window.partitionBy(group).orderBy(name)
    return df.withColumn("turn", F.row_number().over(w).cast("long")).withColumn("group_order", F.min(name).over(Window.partitionBy(group)))


def fair_turns(df: DataFrame, batch: str, group: str, order: str) -> DataFrame:
    """serve: how many of the group's items come before in this and all earlier batches. Taking by (serve, group) in a
    batch is the same as always serving the group served least so far."""
    w = Window.partitionBy(group).orderBy(batch, order)
    return df.withColumn("serve", (F.row_number().over(w) - 1).cast("long")).withColumn("place", F.row_number().over(Window.partitionBy(batch).orderBy("serve", group)).cast("long"))


def running_totals(df: DataFrame, keys: list[str], order: str, sums: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.select("*", *(F.sum(c).over(w).alias(f"total_{c}") for c in sums))


def last_n(df: DataFrame, keys: list[str], order: str, column: str, n: int = 100, name: str = "trend", width: int = 1 << 16) -> DataFrame:
    """The values of the last n rows up to each. Without keys, rows are dealt into ranges of `width` in order, and a
    range also takes the n - 1 rows before it."""
    if keys:
        return df.withColumn(name, F.collect_list(column).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(-(n - 1), 0)))
    rows = ordinal(df, order, "_n")
    part = F.floor(F.col("_n") / width)
    rows = rows.withColumn("_part", F.explode(F.array_distinct(F.array(part, F.floor((F.col("_n") + n - 1) / width)))))
    w = Window.partitionBy("_part").orderBy("_n").rowsBetween(-(n - 1), 0)
    return rows.withColumn(name, F.collect_list(column).over(w)).filter(part == F.col("_part")).drop("_n", "_part")


def latest_as_of(events: DataFrame, key: str, value: str, order: str, boundary: Column, interval: int = 1) -> DataFrame:
    """At each interval-th boundary row: the number of keys seen so far and the sum of their latest values.

    A key's change of value is carried as a difference, so the running sum needs no set of all keys at each boundary.
    """
    if interval <= 0:
        return events.limit(0).select(F.col(order), F.lit(0).cast("long").alias("keys"), F.lit(0).cast("long").alias("latest_sum"))
    w = Window.partitionBy(key).orderBy(order)
    seen = F.lag(value).over(w)
    marked = events.select(order, (F.col(value) - F.coalesce(seen, F.lit(0))).alias("_d"), F.when(seen.isNull(), 1).otherwise(0).alias("_k"), boundary.cast("int").alias("_b"))
    out = running_sums(marked, order, {"keys": F.col("_k"), "latest_sum": F.col("_d"), "_nb": F.col("_b")})
    return out.filter((F.col("_b") == 1) & (F.col("_nb") % interval == 0)).select(order, F.col("keys").cast("long").alias("keys"), F.col("latest_sum").cast("long").alias("latest_sum"))


def truncation(df: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """(group, included, excluded) when only the first n rows by order are taken."""
    cutoff = df.select(order).orderBy(order).limit(n).agg(F.max(order).alias("_cut"))
    return df.crossJoin(F.broadcast(cutoff)).groupBy(group).agg(F.count_if(F.col(order) <= F.col("_cut")).alias("included"), F.count_if(F.col(order) > F.col("_cut")).alias("excluded"))


def trim_masked(sequence: Column) -> Column:
    """A consensus without the N at its ends."""
    return F.regexp_replace(sequence, "^N+|N+$", "")


def wrapped(sequence: Column, width: int = 70) -> Column:
    """A sequence in lines of `width` letters; no break at its end."""
    return F.regexp_replace(sequence, f"(.{{{width}}})(?=.)", "$1\n")
