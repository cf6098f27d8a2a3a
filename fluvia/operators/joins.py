"""Joins and set operations on explicit keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def classify_halves(left: DataFrame, right: DataFrame, keys: list[str], missing_left: str = "right_only", missing_right: str = "left_only") -> DataFrame:
    """A full join of the distinct keys that says for each whether both sides have it."""
    a, b = left.select(*keys).distinct().withColumn("_a", F.lit(True)), right.select(*keys).distinct().withColumn("_b", F.lit(True))
    kind = F.when(F.col("_a").isNull(), missing_left).when(F.col("_b").isNull(), missing_right).otherwise("matched")
    return a.join(b, keys, "full").select(*keys, kind.alias("kind"))


def pair_complete(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that both sides have; an inner join says the same as a full one whose half rows are dropped."""
    return left.join(right, keys, "inner")


def either(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both sides by key, nulls where a side has none."""
    return left.join(right, keys, "full")


def failed(samples: DataFrame, produced: DataFrame | None) -> DataFrame | None:
    """Samples that produced nothing; None where what was produced is not known."""
    return None if produced is None else samples.select("sample_id").distinct().join(produced.select("sample_id"), "sample_id", "left_anti")


def produced(*stages: DataFrame) -> DataFrame:
    """Samples that every stage has."""
    out = stages[0].select("sample_id").distinct()
    for s in stages[1:]:
        out = out.join(s.select("sample_id"), "sample_id", "left_semi")
    return out


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def branch(df: DataFrame, condition) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the condition, and all others, nulls among them."""
    return df.filter(condition), df.filter(~F.coalesce(condition, F.lit(False)))
