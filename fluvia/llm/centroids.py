"""Centroid clustering of integer vectors, with distances screened by block norms.

A vector's components become integers, and its segments' Euclidean norms are computed once and kept with it. For a
vector x and a centroid c, the Cauchy-Schwarz inequality in each segment gives |x - c|^2 >= sum of (|x_s| - |c_s|)^2 over
segments. The centroid of the least bound is measured first; only centroids whose bound does not exceed that distance
get an exact one, in integers. Bounds are lowered by more than what rounding can add, so the result is that of all
distances. A round's tasks add up their vectors by centroid before anything is shuffled, and what reaches the driver is
the new centroids (k * d numbers).

Defined cases: vectors null, of another length, or with null or non-finite components take no part; ties go to the smaller
centroid; repeated rows are vectors of their own, in the first centroids too; a vector whose id is null is clustered
but is no first centroid; with fewer vectors than centroids there are as many as vectors with an id, and with none of
these the result is empty; an empty table gives none; other columns are ignored. Integers beyond +-2**27 raise
an error, as squared distances would leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, staged

K, ROUNDS, SCALE, DIMENSIONS, SEGMENT, SEED = 40, 5, 256, 64, 8, "2"
LARGEST = 1 << 27
#: Over what sums of a segment's squares and their roots in double precision are off by, in proportion.
SLACK = 1e-12


def norms(vectors: np.ndarray, segment: int) -> np.ndarray:
    """The Euclidean norms of the segments of rows; the last one may be shorter."""
    squares = vectors.astype(np.float64) ** 2
    return np.sqrt(np.add.reduceat(squares, np.arange(0, vectors.shape[1], segment), axis=1))


def bounds(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Lower bounds of squared distances, rows of `one` by rows of `many`, from segment norms."""
    out = np.zeros((len(one), len(many)))
    for s in range(one.shape[1]):
        a, b = one[:, s, None], many[None, :, s]
        gap = np.maximum(np.abs(a - b) - SLACK * (a + b), 0)
        out += gap * gap
    return out * (1 - SLACK)


def nearest(vectors: np.ndarray, segments: np.ndarray, centroids: np.ndarray, centroid_segments: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(centroid, squared distance) of each row, and the number of exact distances taken."""
    rows = np.arange(len(vectors))
    least = bounds(segments, centroid_segments)
    first = least.argmin(axis=1)
    found = np.full(least.shape, np.iinfo(np.int64).max)
    found[rows, first] = ((vectors - centroids[first]) ** 2).sum(axis=1)
    open_ = least <= found[rows, first][:, None]
    open_[rows, first] = False
    for c in np.flatnonzero(open_.any(axis=0)).tolist():
        some = np.flatnonzero(open_[:, c])
        found[some, c] = ((vectors[some] - centroids[c]) ** 2).sum(axis=1)
    cluster = found.argmin(axis=1)  # the first of equal ones
    return cluster, found[rows, cluster], len(rows) + int(open_.sum())


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE, dimensions: int = DIMENSIONS, segment: int = SEGMENT) -> DataFrame:
    """(id, v, s): the vectors that take part, as 32-bit integers floor(scale * x), and the norms of their segments."""
    v = F.col("x")
    good = (F.size(v) == dimensions) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("x")).filter(F.coalesce(good, F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column(1).flatten(), np.float64).reshape(batch.num_rows, dimensions)
                x = np.floor(x * scale)
                if np.abs(x).max() > LARGEST:
                    raise OverflowError(f"a component times {scale} is beyond +-2**27")
                v, s = x.astype("<i4"), norms(x, segment)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in v], pa.binary()), pa.array([r.tobytes() for r in s], pa.binary())], ["id", "v", "s"])

    return rows.mapInArrow(run, "id long, v binary, s binary")


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, segment: int):
    """(batch, vectors, cluster, distance) for batches (id, v, s), some thousand rows at once."""
    segments = norms(centroids, segment)
    for whole in batches:
        for at in range(0, whole.num_rows, 4096):
            batch = whole.slice(at, 4096)
            v = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i4").reshape(batch.num_rows, -1).astype(np.int64)
            s = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float64).reshape(batch.num_rows, -1)
            yield batch, v, *nearest(v, s, centroids, segments)[:2]


def first_centroids(rows: DataFrame, k: int = K, seed: str = SEED) -> np.ndarray:
    """The k vectors with the least hashes of seed and id, in that order; of equal ids the least vectors come first."""
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    found = rows.filter("id is not null").orderBy(by, "v").limit(k).select("v").collect()
    return np.array([np.frombuffer(r.v, "<i4") for r in found], np.int64)


def moved(rows: DataFrame, centroids: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """The centroids after one round over rows (id, v, s)."""
    k, d = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, d + 1), np.int64)
        for _, v, cluster, _ in _assigned(batches, centroids, segment):
            np.add.at(total, cluster, np.column_stack([v, np.ones(len(v), np.int64)]))
        c, i = np.nonzero(np.ones_like(total) * (total[:, -1:] > 0))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(i, pa.int32()), pa.array(total[c, i])], ["c", "i", "x"])

    sums = rows.select("id", "v", "s").mapInArrow(run, "c int, i int, x long").groupBy("c", "i").agg(F.sum("x").alias("x")).collect()
    total = np.zeros((k, d + 1), np.int64)
    for r in sums:
        total[r.c, r.i] = r.x
    n = total[:, -1:]
    return np.where(n > 0, total[:, :-1] // np.maximum(n, 1), centroids)  # // rounds down


def assign(rows: DataFrame, centroids: np.ndarray, segment: int = SEGMENT) -> DataFrame:
    """(id, cluster, distance) of rows (id, v, s)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, cluster, distance in _assigned(batches, centroids, segment):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance)], ["id", "cluster", "distance"])

    return rows.select("id", "v", "s").mapInArrow(run, "id long, cluster int, distance long")


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, rounds: int = ROUNDS, scale: int = SCALE, dimensions: int = DIMENSIONS, segment: int = SEGMENT, seed: str = SEED) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance), centroids). k * (dimensions + 1) numbers reach the driver each round."""
    rows = staged(integer_vectors(vectors, id_col, vec_col, scale, dimensions, segment), "centroids-vectors")
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return rows.limit(0).selectExpr("id", "cast(null as int) as cluster", "cast(null as long) as distance"), centroids
    for _ in range(rounds):
        centroids = moved(rows, centroids, segment)
    return staged(assign(rows, centroids, segment), "centroids-assigned"), centroids


def op13_centroids(spark, sf_dir: str) -> DataFrame:
    found, centroids = cluster(read_table(spark, sf_dir, "embeddings"))
    sha = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    named = spark.createDataFrame(sha, "cluster int, centroid_sha256 string")
    by_cluster = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    # One row a centroid, K at most.
    by_cluster = by_cluster.join(named, "cluster").crossJoin(found.agg(F.sum("distance").alias("inertia")))
    return found.join(F.broadcast(by_cluster), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """The same in SQL, each round spelled out; sums of squares are exact in doubles as they stay below 2**53."""
    out = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INTEGER) AS cluster, x
  FROM (SELECT sha256('{SEED}:' || vec_id) AS h, x FROM v WHERE vec_id IS NOT NULL ORDER BY h, x LIMIT {K}))""",
    ]
    for i in range(ROUNDS + 1):
        out.append(f"""a{i} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(x) AS x, min({{'d': d, 'cluster': cluster}}) AS near
  FROM (SELECT v.r, v.vec_id, v.x, c.cluster,
      CAST(list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, c.x) + list_inner_product(c.x, c.x) AS BIGINT) AS d
    FROM v CROSS JOIN c{i} AS c) GROUP BY r)""")
        if i < ROUNDS:
            out.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{i} AS c LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS x FROM (
      SELECT cluster, i, CAST(sum(y) AS BIGINT) AS s, count(*) AS n
      FROM (SELECT near.cluster AS cluster, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM a{i}) GROUP BY cluster, i)
    GROUP BY cluster) AS m USING (cluster))""")
    return "WITH " + ",\n".join(out) + f"""
SELECT vec_id, near.cluster AS cluster, near.d AS distance,
  CAST(sum(near.d) OVER (PARTITION BY near.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(near.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(c.x, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} AS c ON c.cluster = near.cluster"""


OP13_SQL = _sql()
