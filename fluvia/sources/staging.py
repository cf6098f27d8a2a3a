"""Staged tables: cut a lineage by writing Parquet to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where the session names none, a temporary folder, on a single machine only: on a cluster
    each executor would write to a disk of its own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = getattr(spark, "_fluvia_shared", None) or tempfile.mkdtemp(prefix="fluvia-")
        spark._fluvia_shared = at
    return at.rstrip("/")


def fresh_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def staged(df: DataFrame, what: str) -> DataFrame:
    path = fresh_path(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_with(df: DataFrame, what: str, condition: Column) -> tuple[DataFrame, int]:
    """staged(), and the number of its rows that meet a condition, counted while they are written."""
    seen = Observation()
    out = staged(df.observe(seen, F.count_if(condition).alias("n")), what)
    return out, seen.get["n"]
