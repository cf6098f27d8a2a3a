"""A corpus pipeline of five stages; each is a function (spark, docs, sf_dir) -> DataFrame.

Language identification drops documents without a language; line dedup takes repeated runs of two or more lines out of the texts;
SimHash keeps the first row, by id, then by a hash of id and text, of each near-duplicate group (shingles of five words,
wide links, confirmed by a Jaccard similarity of 0.8 or more; the README gives the recall); mixing repeats small sources towards the target weights, at most twice, and takes every row once at least; BPE encoding returns the token ids. All but the last
return the columns of docs. Rows whose id is null pass dedup unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvia.llm import bpe, langid, linededup, mixing, simhash
from fluvia.llm.common import fresh, row_key, staged


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = fresh(docs, "lang_pred", "score")
    found = langid.predict(docs, langid.learn(docs), names=names)
    return found.filter(F.col(names[0]) != langid.UNKNOWN).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own, name = fresh(docs, "own_key", "first_key")
    first = simhash.first_rows(docs).select(F.col("key").alias(name))
    keyed = docs.withColumn(own, row_key(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    kept = keyed.filter("doc_id is not null").join(first, F.col(own) == F.col(name), "left_semi").dropDuplicates([own]).drop(own)
    return kept.unionByName(docs.filter("doc_id is null"))


def weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs).select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("mixing", weights),
    ("bpe", encoding),
]

#: SQL cannot state a language model, fingerprints or merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{name}")
    return docs
