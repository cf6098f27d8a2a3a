"""Helpers shared by the text operators: tables, staged results, byte slices and vectorised hashes."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of bytes other than these six, for bytes.split() and in patterns alike.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a temporary one, on a single machine
    only: on a cluster each executor would write to a disk of its own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = getattr(spark, "_fluvia_shared", None) or tempfile.mkdtemp(prefix="fluvia-")
        spark._fluvia_shared = at
    return at.rstrip("/")


def staged(df: DataFrame, what: str) -> DataFrame:
    """Cut the lineage: write df as a Parquet table in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed_table(df: DataFrame, what: str, by: str, n: int | None = None) -> DataFrame:
    """The same as a table bucketed by a column, so that grouping and joining by it moves no row of it again."""
    spark = df.sparkSession
    name = f"{what}-{uuid.uuid4().hex}"
    n = n or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(n, by).option("path", f"{shared_dir(spark)}/{name}").option("compression", "uncompressed").saveAsTable(name.replace("-", "_"))
    return spark.table(name.replace("-", "_"))


def fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """The names, with as many underscores before them as keep them apart from the columns of df."""
    taken = {c.lower() for c in df.columns}
    while any(n.lower() in taken for n in names):
        names = tuple("_" + n for n in names)
    return names


def crc_bucket(doc_id: Column, n: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def row_key(doc_id: Column, text: Column) -> Column:
    """One long for a row's id and text. Repeated rows share it."""
    return F.xxhash64(doc_id, text)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of about max_bytes of text; a longer text is a run of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum(np.fromiter((x or 0 for x in pa.compute.binary_length(column).to_pylist()), np.int64, len(column)))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + max_bytes, "right")))
            yield batch.slice(at, to - at)
            at = to
        del batch, column
        pa.default_memory_pool().release_unused()  # else a worker keeps what its largest batches took


def joined_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes as one array, and the n + 1 offsets of the rows in it (null: empty)."""
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


#: An odd multiplier and its inverse modulo 2**64, for rolling sums of bytes.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


@functools.lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def powers(base: int, n: int) -> np.ndarray:
    return _powers(base, 1 << max(16, int(n).bit_length()))[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """n + 1 sums over (byte + 1) * BASE**i modulo 2**64; spans() makes hashes of any substrings from them."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=out[1:])
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the substrings [start, end): equal strings have equal hashes wherever they are."""
    return mixed((sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts])
