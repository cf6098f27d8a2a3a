"""Streams with keyed state: count-or-timer batches, running taxa of samples, results kept by batch.

The state lives in the state store, or in tables that each micro-batch makes anew where a key may have more rows than a
task should hold, and survives a restart from the checkpoint. What is still held when a stream ends is read from there
(remainder()), so nothing is lost at close. Rows of a key are taken in their own
order within a micro-batch, so the result does not depend on how files are dealt to micro-batches as long as they come in
that order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import SparkRuntimeException
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from fluvia.sources.staging import fresh_path, staged

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream with keyed state over what is there; the rows of a micro-batch are a partition of the table at path,
    which a batch that runs again replaces."""
    spark = stream.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, PROVIDER)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    try:
        stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def written(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows of run(), with the number of their micro-batch; none before the first."""
    schema = StructType([*schema.fields, StructField("batch", LongType())])
    spark.createDataFrame([], schema).drop("batch").write.mode("overwrite").parquet(f"{path}/batch=-1")
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def started(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a micro-batch has been committed."""
    try:
        return not spark.read.format("state-metadata").option("path", checkpoint).load().isEmpty()
    except SparkRuntimeException as e:
        if e.getCondition() == "STDS_COMMITTED_BATCH_UNAVAILABLE":
            return False
        raise


def held(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """What a state variable holds at the end of the last micro-batch."""
    return spark.read.format("statestore").option("path", checkpoint).option("operatorId", 0).option("stateVarName", variable).load()


class CountOrTick(StatefulProcessor):
    """A buffer for each key, given out when it has n items and whenever a timer ticks at its fixed rate, which is counted
    from the key's first item (or from `start`) and which full buffers do not put off. Rows are (key, at, item): `at` in
    milliseconds. Without a period only the count gives out. An item that comes at a tick belongs after it."""

    def __init__(self, n: int, period: int | None, start: int | None = None):
        self.n, self.period, self.first = n, period, start

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getListState("buffer", "at long, item long")
        self.clock = handle.getValueState("clock", "start long, tick long, given long")

    def _batch(self, key: tuple, number: int, items: list[tuple[int, int]]) -> Iterator[Row]:
        for at, item in items:
            yield Row(stream=key[0], number=number, at=at, item=item)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        start, tick, given = self.clock.get() if self.clock.exists() else (self.first, 0, 0)
        items = [(x[0], x[1]) for x in self.buffer.get()] if self.buffer.exists() else []
        for r in sorted(rows, key=lambda r: (r.at, r.item)):
            start = r.at if start is None else start
            now = (r.at - start) // self.period if self.period else 0
            if now > tick:
                if items:
                    yield from self._batch(key, given, items)
                    items, given = [], given + 1
                tick = now
            items.append((r.at, r.item))
            if len(items) >= self.n:
                yield from self._batch(key, given, items)
                items, given = [], given + 1
        self.clock.update((start, tick, given))
        if not items:
            self.buffer.clear()
            return
        self.buffer.put(items)
        if self.period:
            self.handle.registerTimer(start + (tick + 1) * self.period)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        start, tick, given = self.clock.get()
        due = (expiredTimerInfo.getExpiryTimeInMs() - start) // self.period
        items = [(x[0], x[1]) for x in self.buffer.get()] if self.buffer.exists() else []
        if due > tick:
            self.clock.update((start, due, given + bool(items)))
            self.buffer.clear()
            yield from self._batch(key, given, items)

    def close(self) -> None:
        pass


BATCHED = "stream string, number long, at long, item long"


def count_or_tick(stream: DataFrame, n: int, seconds: float | None, late: str = "1 day", start: int | None = None) -> DataFrame:
    """(stream, number, at, item) of a stream (stream, ts, item), by event time: a tick also passes when the watermark
    does, so a quiet key's buffer is given out then."""
    rows = stream.select("stream", F.col("ts").cast("timestamp").alias("ts"), F.col("item").cast("long").alias("item")).withWatermark("ts", late)
    rows = rows.withColumn("at", F.unix_millis("ts"))
    return rows.groupBy("stream").transformWithState(CountOrTick(n, int(seconds * 1000) if seconds else None, start), BATCHED, "update", "EventTime")


def remainder(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The last batch of each key: what its buffer holds at the end."""
    if not started(spark, checkpoint):
        return spark.createDataFrame([], BATCHED)
    items = held(spark, checkpoint, "buffer").select(F.col("key.*"), F.col("list_element.*"))
    clock = held(spark, checkpoint, "clock").select(F.col("key.*"), F.col("value.given").alias("number"))
    return items.join(clock, "stream").select("stream", "number", "at", "item")


class Versions:
    """Small and large tables that each micro-batch of foreachBatch() makes anew from those before it. A batch that runs
    again finds the same tables before it; of each table the last two are kept."""

    def __init__(self, spark: SparkSession, path: str, schemas: dict[str, str]):
        self.spark, self.path, self.schemas = spark, path, schemas

    def _folders(self, name: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        files = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return files, {int(x.getPath().getName()[6:]): x.getPath() for x in (files.listStatus(at) if files.exists(at) else ()) if x.getPath().getName().startswith("batch=")}

    def before(self, batch_id: int | None = None) -> list[DataFrame]:
        """The tables as they were before a micro-batch, or as they are; empty before the first."""
        # The table named last is written last, so a batch of which it is missing was not finished.
        known = [i for i in self._folders(list(self.schemas)[-1])[1] if batch_id is None or i < batch_id]
        read = lambda name, schema: self.spark.read.schema(schema).parquet(f"{self.path}/{name}/batch={max(known)}") if known else self.spark.createDataFrame([], schema)
        return [read(*x) for x in self.schemas.items()]

    def put(self, batch_id: int, *tables: DataFrame) -> None:
        for name, table in zip(self.schemas, tables):
            table.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={batch_id}")
        for name in self.schemas:
            files, found = self._folders(name)
            for i in sorted(i for i in found if i < batch_id)[:-1]:
                files.delete(found[i], True)


def _each(stream: DataFrame, checkpoint: str, work) -> None:
    """Run a stream over what is there: work(rows, batch_id) for each micro-batch, its rows as a table of the stream's own
    session, which plans adaptively."""
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        at = fresh_path(spark, "arrived")
        batch.write.parquet(at)
        work(spark.read.schema(batch.schema).parquet(at), batch_id)

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


_CLOCK = "stream string, start long, tick long, given long, newest long"


def _dealt(rows: DataFrame, held: DataFrame, clock: DataFrame, n: int, period: int | None, late: int, first: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(batches, held, clock) after rows (stream, at, item), by the rules of CountOrTick. held: (stream, pos, at, item).

    A key's rows are not gathered: all rows are sorted by range over the tasks, a row's place in its tick is its place in
    its range and the rows of the ranges before, and only counts of ticks meet in windows.
    """
    newest = clock.agg(F.max("newest")).first()[0]
    if newest is not None:
        rows = rows.filter(F.col("at") > newest - late)
    came = rows.groupBy("stream").agg(F.min("at").alias("_least"), F.max("at").alias("_most"))
    clock = came.join(clock, "stream", "full").select("stream", F.coalesce("start", F.lit(first).cast("long"), "_least").alias("start"), *(F.coalesce(c, F.lit(0)).alias(c) for c in ("tick", "given")), F.greatest("newest", "_most").alias("newest"))
    clock = staged(clock, "ticks-clock")
    tick = F.greatest("tick", F.expr(f"(at - start) div {period}L")) if period else F.col("tick")
    new = rows.join(clock, "stream").select("stream", tick.alias("tick"), F.lit(n).cast("long").alias("pos"), "at", "item")
    order = ("stream", "tick", "pos", "at", "item")
    every = new.unionByName(held.join(clock, "stream").select(*order))
    ranked = staged(every.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_i", F.monotonically_increasing_id()), "ticks-ranked")
    ranked = ranked.withColumn("_part", F.shiftright("_i", 33))
    ranges = ranked.groupBy("stream", "tick", "_part").agg(F.count("*").alias("_c"), F.min("_i").alias("_first"))
    ahead = Window.partitionBy("stream", "tick").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = staged(ranges.withColumn("_ahead", F.coalesce(F.sum("_c").over(ahead), F.lit(0))), "ticks-ranges")
    by_tick = Window.partitionBy("stream").orderBy("tick")
    full = F.ceil(F.col("_n") / n)
    ticks = ranges.groupBy("stream", "tick").agg(F.sum("_c").alias("_n")).join(clock.select("stream", "start", "given"), "stream")
    ticks = ticks.select("stream", "tick", "start", "_n", (F.col("given") + F.coalesce(F.sum(full).over(by_tick.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("_base"), F.lead("tick").over(by_tick).isNull().alias("_last"))
    most = clock.agg(F.max("newest")).first()[0]
    # The watermark may have passed the end of a key's last tick, which gives out what is held.
    over = F.lit(False) if not period or most is None else F.col("start") + (F.col("tick") + 1) * period <= most - late
    ticks = ticks.withColumns({"_whole": F.col("_n") - F.when(F.col("_last") & ~over, F.col("_n") % n).otherwise(0), "_over": F.col("_last") & over & (F.col("_n") % n > 0)})
    ticks = staged(ticks, "ticks")
    places = ranges.join(ticks.select("stream", "tick", "_base", "_whole"), ["stream", "tick"]).drop("_c")
    placed = ranked.join(places, ["stream", "tick", "_part"]).withColumn("_row", F.col("_i") - F.col("_first") + F.col("_ahead"))
    out = placed.filter("_row < _whole").select("stream", (F.col("_base") + F.expr(f"_row div {n}L")).alias("number"), "at", "item")
    left = placed.filter("_row >= _whole").select("stream", (F.col("_row") - F.col("_whole")).alias("pos"), "at", "item")
    last = ticks.filter("_last").select("stream", (F.col("tick") + F.col("_over").cast("long")).alias("_tick"), (F.col("_base") + F.ceil(F.col("_whole") / n)).alias("_given"))
    clock = clock.join(last, "stream", "left").select("stream", "start", F.coalesce("_tick", "tick").alias("tick"), F.coalesce("_given", "given").alias("given"), "newest")
    return out, left, clock


def batched(stream: DataFrame, n: int, seconds: float | None, path: str | None = None, late: str = "1 day") -> DataFrame:
    """All batches of a stream over what is there, by the rules of count_or_tick(), the remainder at close included. A key
    may have any number of rows: they are numbered by ranges (see _dealt()), no task holds a key. What is held goes from
    micro-batch to micro-batch in tables."""
    spark = stream.sparkSession
    path = path or fresh_path(spark, "batched")
    state = Versions(spark, f"{path}/state", {"held": "stream string, pos long, at long, item long", "clock": _CLOCK})
    wait = int(pd.Timedelta(late).total_seconds() * 1000)

    def work(rows: DataFrame, batch_id: int) -> None:
        out, held, clock = _dealt(rows, *state.before(batch_id), n, int(seconds * 1000) if seconds else None, wait)
        out.write.mode("overwrite").parquet(f"{path}/table/batch={batch_id}")
        state.put(batch_id, held, clock)

    _each(stream.select("stream", F.unix_millis(F.col("ts").cast("timestamp")).alias("at"), F.col("item").cast("long").alias("item")), f"{path}/checkpoint", work)
    held, clock = state.before()
    rest = held.join(clock.select("stream", F.col("given").alias("number")), "stream").select("stream", "number", "at", "item")
    return written(spark, f"{path}/table", rest.schema).drop("batch").unionByName(rest)


REPORT = "sample_id string, batches long, taxid string, reads long, cumul long, rank string, name string, parent string"
_TAXA = "sample_id string, taxid string, reads long, cumul long, rank string, name string, parent string"


def _merged(rows: DataFrame, taxa: DataFrame, seen: DataFrame, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(reports, taxa, seen) after a micro-batch of rows.

    Rows are summed up by the report that they are due for, and sums run over a taxon's reports; each stands until the
    taxon's next one. Nothing gathers a sample.
    """
    own = rows.select("sample_id", "batch_id").distinct().join(seen, "sample_id", "left")
    number = F.coalesce("batches", F.lit(0)) + F.row_number().over(Window.partitionBy("sample_id").orderBy("batch_id"))
    own = staged(own.select("sample_id", "batch_id", number.cast("long").alias("_n")), "taxa-batches")
    due = F.when(F.col("_n") == 1, 1).otherwise(F.ceil(F.col("_n") / k) * k) if k > 0 else F.col("_n")
    first = F.struct("_n", "rank", "name")
    new = rows.join(F.broadcast(own.withColumn("_due", due)), ["sample_id", "batch_id"]).groupBy("sample_id", "taxid", "_due").agg(
        F.sum("reads").alias("reads"), F.sum("cumul").alias("cumul"), F.min(first).alias("_first"), F.min(F.when(F.col("parent").isNotNull(), F.struct("_n", "parent"))).alias("_parent"),
    )
    new = new.select("sample_id", "taxid", F.col("_due").cast("long").alias("_due"), "reads", "cumul", F.col("_first.rank").alias("rank"), F.col("_first.name").alias("name"), F.col("_parent.parent").alias("parent"))
    w = Window.partitionBy("sample_id", "taxid").orderBy("_due")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    every = taxa.withColumn("_due", F.lit(0).cast("long")).unionByName(new)
    every = every.select("sample_id", "taxid", *(F.sum(c).over(so_far).alias(c) for c in ("reads", "cumul")), *(F.first(c).over(so_far).alias(c) for c in ("rank", "name")), F.first("parent", ignorenulls=True).over(so_far).alias("parent"), "_due", F.lead("_due").over(w).alias("_next"))
    every = staged(every, "taxa-sums")
    dues = own.filter((F.col("_n") == 1) | (F.lit(k <= 0) | (F.col("_n") % max(k, 1) == 0))).groupBy("sample_id").agg(F.collect_list("_n").alias("_dues"))
    stands = F.filter("_dues", lambda x: (x >= F.col("_due")) & (F.col("_next").isNull() | (x < F.col("_next"))))
    reports = every.join(F.broadcast(dues), "sample_id").withColumn("batches", F.explode(stands)).select("sample_id", "batches", "taxid", "reads", "cumul", "rank", "name", "parent")
    now = own.groupBy("sample_id").agg(F.max("_n").alias("_now")).join(seen, "sample_id", "full").select("sample_id", F.coalesce("_now", "batches").alias("batches"))
    return reports, every.filter("_next is null").drop("_due", "_next"), now


def reported(stream: DataFrame, k: int, path: str | None = None) -> DataFrame:
    """The merged report of each sample over what is there: reads and cumul added up over batches, rank and name as first
    seen, the first known parent. The whole report is given out after a sample's first batch, each k-th one (k <= 0: each)
    and the last. Rows are (sample_id, batch_id, taxid, reads, cumul, rank, name, parent); a batch's rows come in one
    micro-batch. The sums so far go from micro-batch to micro-batch in tables."""
    spark = stream.sparkSession
    path = path or fresh_path(spark, "taxa")
    state = Versions(spark, f"{path}/state", {"taxa": _TAXA, "seen": "sample_id string, batches long"})

    def work(rows: DataFrame, batch_id: int) -> None:
        reports, taxa, seen = _merged(rows, *state.before(batch_id), k)
        reports.write.mode("overwrite").parquet(f"{path}/table/batch={batch_id}")
        state.put(batch_id, taxa, seen)

    _each(stream.select("sample_id", "batch_id", "taxid", "reads", "cumul", "rank", "name", "parent"), f"{path}/checkpoint", work)
    taxa, seen = state.before()
    given = written(spark, f"{path}/table", spark.createDataFrame([], REPORT).schema).drop("batch")
    last = seen.join(given.select("sample_id", "batches").distinct(), ["sample_id", "batches"], "left_anti")
    return given.unionByName(taxa.join(last, "sample_id").select(*given.columns))


class ByBatch(StatefulProcessor):
    """Each key's results by batch: a batch that comes again replaces its own and keeps its place, the order is that of
    first arrival. After each micro-batch the key's whole set is given out. Rows are (key, batch_id, arrival, total,
    hits); of several rows of one batch in a micro-batch the one of the greatest arrival counts."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        # One value for a key: it is given out whole anyway, and each call of the state is a round trip.
        self.results = handle.getValueState("results", "results array<struct<batch_id: string, total: bigint, hits: bigint>>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        found = {x[0]: (x[1], x[2]) for x in self.results.get()[0]} if self.results.exists() else {}
        for r in sorted(rows, key=lambda r: r.arrival):
            found[str(r.batch_id)] = (r.total, r.hits)  # one that is there keeps its place
        self.results.update(([(b, *x) for b, x in found.items()],))
        yield Row(sample_id=key[0], taxid=key[1], batches=list(found), total=sum(x[0] for x in found.values()), hits=sum(x[1] for x in found.values()))

    def close(self) -> None:
        pass


RESULTS = "sample_id string, taxid string, batches array<string>, total long, hits long"


def by_batch(stream: DataFrame) -> DataFrame:
    columns = ("sample_id", "taxid", "batch_id", "arrival", "total", "hits")
    return stream.select(*columns).groupBy("sample_id", "taxid").transformWithState(ByBatch(), RESULTS, "update", "None")


def accumulated(stream: DataFrame, path: str | None = None) -> DataFrame:
    """Run by_batch() over what is there: each key's last set."""
    spark = stream.sparkSession
    path = path or fresh_path(spark, "by-batch")
    made = by_batch(stream)
    run(made, f"{path}/table", f"{path}/checkpoint")
    w = Window.partitionBy("sample_id", "taxid").orderBy(F.desc("batch"))
    return written(spark, f"{path}/table", made.schema).withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "batch")
