"""Live queries: stop on a budget of time or items, session totals carried over restarts, metrics of what passes by."""

from __future__ import annotations

import threading
import time
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import LongType, StructField, StructType


def _stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The micro-batches stored under path, with batch_id; none is an empty table."""
    schema = StructType([*schema.fields, StructField("batch_id", LongType())])
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def admit(stream: DataFrame, path: str, checkpoint: str, order: list[str | Column], most: int | None = None, seconds: float | None = None, idle: float | None = None) -> DataFrame:
    """Run a stream until `most` rows have been admitted, or for `seconds` from its start, or until nothing has come for
    `idle` seconds, whichever is first; the rows admitted so far, those of earlier runs from the checkpoint included.

    The micro-batch that is under way when time is up is finished, as its rows were admitted in time; none after it is
    taken. Of the micro-batch in which the number is reached, the first rows in `order` are. Each micro-batch replaces its
    own partition, and what came before it is counted from the partitions, so a batch that runs again changes nothing.
    Rows that were not admitted stay unread by a later run only if their micro-batch was stopped, not if it was cut.
    """
    spark = stream.sparkSession
    running, full = threading.Lock(), threading.Event()
    closed, came = False, time.monotonic()

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal came
        with running:
            if closed:
                raise _Closed
            rows = batch
            if most is not None:
                left = most - _stored(batch.sparkSession, path, stream.schema).filter(F.col("batch_id") < batch_id).count()
                rows = batch.orderBy(*order).limit(max(left, 0))
            rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            now = _stored(batch.sparkSession, path, stream.schema)
            came = time.monotonic()
            if most is not None and now.count() >= most:
                full.set()

    began = time.monotonic()
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    while query.isActive and not full.wait(0.02):
        now = time.monotonic()
        if (seconds is not None and now - began >= seconds) or (idle is not None and now - max(came, began) >= idle):
            break
    with running:
        closed = True
    failure = None if query.isActive else query.exception()
    query.stop()
    if failure is not None:
        raise failure
    return _stored(spark, path, stream.schema)


class _Closed(Exception):
    """A micro-batch came after the budget."""


def carry(stream: DataFrame, totals: dict[str, Column], path: str, checkpoint: str) -> DataFrame:
    """Session totals after each micro-batch: (batch_id, rows of the batch summed up by `totals`, and each of them over
    the session as total_<name>). totals: sums or counts. A batch's row is made from its own rows and the row before it,
    so it survives restarts, and a batch that runs again replaces its row."""
    spark = stream.sparkSession
    schema = StructType([StructField(x, LongType()) for x in (*totals, *(f"total_{x}" for x in totals))])

    def write(batch: DataFrame, batch_id: int) -> None:
        before = _stored(batch.sparkSession, path, schema).filter(F.col("batch_id") < batch_id).orderBy(F.desc("batch_id")).first()
        own = batch.agg(*(F.coalesce(c, F.lit(0)).cast("long").alias(x) for x, c in totals.items()))
        own = own.select(*totals, *((F.col(x) + F.lit(before[f"total_{x}"] if before else 0)).cast("long").alias(f"total_{x}") for x in totals))
        own.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return _stored(spark, path, schema)


class Metrics(StreamingQueryListener):
    """Rows of the metrics that a stream observes, one a micro-batch, and a warning for a source that gave nothing.

    Use as `with Metrics(spark) as m:` around the query; observe() puts the metrics into the stream. Spark tells of a
    micro-batch some time after it, so the listener waits for the end of each query it has seen start.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.rows, self.read, self.ended = spark, [], {}, {}

    def __enter__(self) -> Metrics:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        until = time.monotonic() + 30
        while any(not x.is_set() for x in list(self.ended.values())) and time.monotonic() < until:
            time.sleep(0.02)
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self.ended[str(event.runId)], self.read[str(event.runId)] = threading.Event(), 0

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.read[str(p.runId)] = self.read.get(str(p.runId), 0) + p.numInputRows
        for name, row in p.observedMetrics.items():
            self.rows.append({"name": name, "batch_id": p.batchId, "rows": p.numInputRows, **row.asDict()})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self.ended:
            self.ended[str(event.runId)].set()

    def warnings(self) -> Iterator[str]:
        """One for each query that ended without a row."""
        return (f"query {run}: the source was empty" for run, x in self.ended.items() if x.is_set() and not self.read.get(run))

    def table(self, name: str, schema: str) -> DataFrame:
        """The observed rows of one name, a row a micro-batch: (batch_id, and the columns of schema)."""
        wanted = [x.split()[0] for x in schema.split(", ")]
        return self.spark.createDataFrame([(r["batch_id"], *(r[c] for c in wanted)) for r in self.rows if r["name"] == name], f"batch_id long, {schema}")


def observe(stream: DataFrame, name: str, barcodes: list[str] | None = None, barcode: str = "sample_id", priority: str = "priority_score") -> DataFrame:
    """A stream of files that tells, each micro-batch: files, the range of priorities, and files of each named barcode."""
    own = [F.count_if(F.col(barcode) == b).alias(f"files_{b}") for b in barcodes or []]
    return stream.observe(name, F.count(F.lit(1)).alias("files"), F.min(priority).alias("min_priority"), F.max(priority).alias("max_priority"), *own)
