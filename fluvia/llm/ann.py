"""Approximate nearest neighbours by a permutation index.

Pivots are a bounded, hash-chosen sample of distinct vectors. A vector is represented by the pivots in order of their
distance to it, as each pivot's place, cut at `prefix`. The index is dealt into parts of about `part_rows` distinct
vectors; in each part every vector is posted in the inverted files of its `post` nearest pivots. A query opens the files
of its own `probe` nearest pivots in every part and counts how often it meets each entry; those met `shared` times at
least, or else the most often met, are ranked once by the footrule distance of the places (the sum over pivots of the
difference of their places), and the best `rerank` share of the part's rows (LEAST_RERANK at least) is measured exactly on
the original vectors, in double precision. Queries meet a part in groups of `query_rows`.

Equal vectors are one entry that carries its smallest TOP + 1 ids, which is all a list of TOP neighbours can take of
them; nothing else is cut before the footrule ranking.

Defined cases: null vectors, zero vectors and such with null or non-finite components take no part; vectors of another
length than most are measured exactly against their like alone; a null vec_id takes no part; repeated rows of one id
count once; an id with several vectors is as near as its nearest and asks with the least in order; with fewer than TOP
candidates, all reached are returned; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import read_table, staged

TOP, PIVOTS, PREFIX, POST, PROBE, SHARED, RERANK, LEAST_RERANK, PART_ROWS, QUERY_ROWS, EVERY = 10, 512, 255, 32, 32, 3, 0.008, 200, 20_000, 2_000, 100
BROADCAST_LENGTHS = 10_000


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.filter(F.col("id").isNotNull() & F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False)))


def distinct_vectors(v: DataFrame, top: int = TOP) -> DataFrame:
    """(key, v, ids): equal vectors as one row with their smallest top + 1 ids. Salted, so that a very common vector
    meets in one task only as a few ids of each salt."""
    v = v.select("id", F.transform("v", lambda x: F.when(x == 0, F.abs(x)).otherwise(x)).alias("v")).select("id", "v", F.xxhash64("v").alias("key")).dropDuplicates(["key", "id"])
    w = Window.partitionBy("key", "salt").orderBy("id")
    part = v.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64))).withColumn("r", F.row_number().over(w)).filter(F.col("r") <= top + 1)
    part = part.groupBy("key").agg(F.min_by("v", "id").alias("v"), F.slice(F.sort_array(F.collect_list("id")), 1, top + 1).alias("ids"))
    return part


def pivots(distinct: DataFrame, n: int = PIVOTS) -> np.ndarray:
    """n vectors at most reach the driver: those with the least hashes of all distinct vectors of the usual length."""
    usual = distinct.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if usual is None:
        return np.empty((0, 0))
    return np.array([r.v for r in distinct.filter(F.size("v") == usual.d).orderBy(F.xxhash64("key"), "key").limit(n).collect()])


def places(rows: np.ndarray, pivot: np.ndarray, prefix: int) -> np.ndarray:
    """The place of each pivot in each row's order (ties to the first pivot), `prefix` from there on."""
    gap = (rows * rows).sum(1)[:, None] - 2 * rows @ pivot.T + (pivot * pivot).sum(1)[None, :]
    place = np.empty(gap.shape, np.int64)
    np.put_along_axis(place, np.argsort(gap, axis=1, kind="stable"), np.arange(len(pivot))[None, :], 1)
    return np.minimum(place, prefix).astype(np.uint8)


def placed(vectors: DataFrame, pivot: np.ndarray, prefix: int) -> DataFrame:
    """Rows with `place`, a byte for each pivot; none for vectors of another length than the pivots'."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            place = [b""] * len(part)
            fits = np.flatnonzero([len(x) == pivot.shape[1] for x in part.v]) if len(pivot) else []
            for at in range(0, len(fits), 1024):
                some = fits[at : at + 1024]
                for i, x in zip(some, places(np.stack(part.v.iloc[some].to_list()).astype(float), pivot, prefix)):
                    place[i] = x.tobytes()
            yield part.assign(place=place)

    return vectors.mapInPandas(run, StructType([*vectors.schema.fields, StructField("place", BinaryType())])).withColumn("d", F.size("v"))


def footrule(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Footrule distances of one row of places to many."""
    return np.subtract(np.maximum(many, one), np.minimum(many, one)).sum(axis=1, dtype=np.int32)


class _Files:
    """The inverted files of one part: the entries by each of their `post` nearest pivots."""

    def __init__(self, place: np.ndarray, post: int):
        self.place = place
        pivot, self.entries = np.nonzero((place < post).T)
        self.bounds = np.searchsorted(pivot, np.arange(place.shape[1] + 1))

    def ranked(self, place: np.ndarray, probe: int, shared: int, n: int) -> np.ndarray:
        """The n entries of the least footrule distance to a query, of those in `shared` of the files of its `probe`
        nearest pivots; where these are fewer than n, the n that are in most of the files."""
        met = np.zeros(len(self.place), np.int16)
        for p in np.flatnonzero(place < probe).tolist():
            met[self.entries[self.bounds[p] : self.bounds[p + 1]]] += 1  # an entry stands once in a file
        found = np.flatnonzero(met >= shared)
        if len(found) < n < len(met):
            return np.argpartition(-met, n - 1)[:n]
        if len(found) < n:
            return np.arange(len(met))
        return found[np.argpartition(footrule(place, self.place[found]), n - 1)[:n]] if n < len(found) else found


def search(vectors: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", top: int = TOP, n_pivots: int = PIVOTS, prefix: int = PREFIX, post: int = POST, probe: int = PROBE, shared: int = SHARED, rerank: float = RERANK, least_rerank: int = LEAST_RERANK, part_rows: int = PART_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of `vectors` whose id satisfies is_query (a function of a column)."""
    v = usable(vectors, id_col, vec_col)
    distinct = staged(distinct_vectors(v, top), "ann-distinct")
    pivot = pivots(distinct, n_pivots)
    entries = staged(placed(distinct, pivot, prefix), "ann-places")
    asked = staged(placed(v.filter(is_query(F.col("id"))).groupBy("id").agg(F.min("v").alias("v")), pivot, prefix), "ann-queries")
    # One row for each length of vectors.
    parts = entries.groupBy("d").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts")).join(asked.groupBy("d").agg(F.ceil(F.count("*") / query_rows).cast("int").alias("groups")), "d")
    parts = staged(parts, "ann-parts")
    if parts.count() <= BROADCAST_LENGTHS:
        parts = F.broadcast(parts)
    entries = entries.join(parts, "d").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")).withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).select("d", "part", "group", "v", "ids", "place")
    asked = asked.join(parts, "d").withColumn("group", F.pmod(F.xxhash64("id"), F.col("groups")).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("d", "part", "group", "v", "id", "place")

    def run(key, q: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(e):
            flat = lambda x: np.frombuffer(b"".join(x), np.uint8).reshape(len(x), -1)
            qp, ep = flat(q.place.to_list()), flat(e.place.to_list())
            qv, ev = np.stack(q.v.to_list()).astype(float), np.stack(e.v.to_list()).astype(float)
            ids = [np.asarray(x, np.int64) for x in e.ids]
            files = _Files(ep, post) if ep.shape[1] else None
            n = max(least_rerank, int(np.ceil(rerank * len(e))))
            for me, place, own in zip(q.id.to_list(), qp, qv):
                near = files.ranked(place, probe, shared, n) if files is not None else np.arange(len(e))
                gap = np.sqrt(((ev[near] - own) ** 2).sum(1))
                best = gap <= np.partition(gap, top)[top] if len(gap) > top + 1 else gap == gap
                found = [(d, x) for d, b in zip(gap[best].tolist(), near[best]) for x in ids[b].tolist() if x != me]
                out += [(me, x, d) for d, x in sorted(found)[:top]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    by = ["d", "part", "group"]
    found = asked.groupBy(*by).cogroup(entries.groupBy(*by)).applyInPandas(run, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def op7_permutation(spark, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "embeddings"), lambda i: i % EVERY == 0)
