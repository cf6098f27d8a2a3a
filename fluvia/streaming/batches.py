"""Streams of files: watched folders, idempotent batch tables, running totals and event-time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fluvia.operators.windows import first_per_key
from fluvia.sources.staging import fresh_path


def watch(spark: SparkSession, path: str, schema: StructType | str, kind: str = "parquet", files_per_batch: int | None = None, names: str | None = None) -> DataFrame:
    """Files that are in a folder or come to it. Names that start with a dot or an underscore are skipped;
    `names`, a glob pattern, keeps some of the others only."""
    reader = spark.readStream.format(kind).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if names:
        reader = reader.option("pathGlobFilter", names)
    return reader.load(path)


def store(stream: DataFrame, path: str, checkpoint: str):
    """Write each micro-batch to its own partition, overwriting it, so that a batch that runs again replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches of store(), with batch_id."""
    return spark.read.schema(schema + ", batch_id long").option("basePath", path).parquet(path)


def running_counts(stream: DataFrame, keys: list[str]) -> DataFrame:
    """A count for each key; the state holds one row a key."""
    return stream.groupBy(*keys).agg(F.count("*").alias("n"))


def windowed(stream: DataFrame, ts: Column, keys: list[str], values: list[Column], width: str, late: str, slide: str | None = None) -> DataFrame:
    """Aggregates over event-time windows; rows that come more than `late` after the newest are left out, state is bounded."""
    s = stream.withColumn("_ts", ts.cast("timestamp")).withWatermark("_ts", late)
    w = F.window("_ts", width, slide) if slide else F.window("_ts", width)
    return s.groupBy(w.alias("_w"), *keys).agg(*values).withColumns({"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}).drop("_w")


def deduplicated(stream: DataFrame, ts: Column, keys: list[str], late: str) -> DataFrame:
    """The first row of each key within the watermark."""
    return stream.withColumn("_ts", ts.cast("timestamp")).withWatermark("_ts", late).dropDuplicatesWithinWatermark(keys).drop("_ts")


def finished(stream: DataFrame) -> DataFrame:
    """Run a stream over what is there and return its result as a table: for aggregates, the last complete one."""
    spark = stream.sparkSession
    path = fresh_path(spark, "stream")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/table")

    query = stream.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/table")


def upserted(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Run a stream in update mode over what is there: a table of each key's last row. The watermark is in force: state
    behind it is given up, and rows that come later than it, as it stood one micro-batch before, are left out. The rows that a micro-batch changed are a
    partition of their own, which a batch that runs again replaces. A stream without rows gives an empty table."""
    spark = stream.sparkSession
    path = fresh_path(spark, "stream")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/table/batch_id={batch_id}")

    write(spark.createDataFrame([], stream.schema), -1)
    query = stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    changed = spark.read.schema(StructType([*stream.schema.fields, StructField("batch_id", LongType())])).option("basePath", f"{path}/table").parquet(f"{path}/table")
    return first_per_key(changed, keys, [F.desc("batch_id")]).drop("batch_id")
