"""Line dedup by content-defined chunks, whose edges are then told line by line.

A document's lines with a word are hashed; a rolling hash over the last WINDOW line hashes ends a chunk where it is 0
modulo DIVISOR, so that boundaries depend on nearby lines only and the same lines are cut alike wherever they stand. A
chunk of two lines or more that stands earlier too (smaller doc_id, then position), in the same document or another, is a
copy and goes. A repeated passage begins and ends within chunks, so its edges, and passages too short to hold a boundary,
are in no chunk that repeats. They are found by pieces of two neighbouring lines, which are posted for all lines but those
in a chunk that is a copy: what stands there stands in the chunk's first occurrence too. Pieces that stand earlier too go
as well. As a repeated run of any length is the union of such pieces, every repeated run of two or more lines is found
whole wherever it starts and ends, and the first occurrence of its lines stays; of a document's whole copies the chunks
take nearly all rows, a fraction of the lines.

Chunks and pieces are first grouped by hash and size. Then the bytes of those that meet are read from the texts and
compared: only equal bytes are copies. (A chunk that shares hash and size with other bytes stays, its lines included.)
Occurrences may overlap: of one line three times in a row, one is left. Blank lines go with the lines around them.

Defined cases: a null text stays null and an empty text empty; rows whose id is null keep their text and make nothing
else a copy; repeated rows (same id and text) count as one document, so they do not remove each other's lines but keep
one row each; a document whose lines all go has an empty text. Columns of docs stay, extra ones included.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, read_table, row_key, slices, staged

WINDOW, DIVISOR, SLICE_BYTES = 2, 4, 1 << 19
CHUNK, PAIR = 0, 1
_M = np.uint64(0x9E3779B97F4A7C15)


def chunk_ends(hashes: np.ndarray, window: int = WINDOW, divisor: int = DIVISOR) -> np.ndarray:
    """The line numbers after which a chunk ends, the last line's included."""
    n = len(hashes)
    rolled = np.zeros(n, np.uint64)
    for k in range(window):  # a hash of lines i - window + 1 .. i; lines before the first are 0
        rolled[k:] = rolled[k:] * _M + (hashes[: n - k] if k else hashes)
    rolled ^= rolled >> np.uint64(31)
    return np.union1d(np.flatnonzero((rolled * _M >> np.uint64(20)) % np.uint64(divisor) == 0) + 1, [n])


def worded(text: bytes) -> list[tuple[int, int]]:
    """(start, end) of each line with a word, without its newline."""
    out, at = [], 0
    for line in text.split(b"\n"):
        if line.strip(b" \t\n\r\x0b\x0c"):
            out.append((at, at + len(line)))
        at += len(line) + 1
    return out


def pieces(text: bytes, window: int = WINDOW, divisor: int = DIVISOR) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, chunk): chunks of two or more lines, and each two neighbouring lines; chunk is the start of
    the chunk that holds a piece, -1 if it lies in two of them."""
    lines = worded(text)
    if len(lines) < 2:
        return []
    ends = chunk_ends(np.fromiter((xxhash.xxh64_intdigest(text[s:e]) for s, e in lines), np.uint64, len(lines)), window, divisor)
    out, first = [], 0
    for end in ends.tolist():
        chunk = lines[first][0]
        if end - first > 1:
            out.append((CHUNK, chunk, lines[end - 1][1], chunk))
        out += [(PAIR, lines[i][0], lines[i + 1][1], chunk) for i in range(first, end - 1)]
        if end < len(lines):
            out.append((PAIR, lines[end - 1][0], lines[end][1], -1))
        first = end
    return out


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(row_key(F.col(id_col).cast("long"), text).alias("_key"), F.col(id_col).cast("long").alias("_id"), text.alias("_text"))


def cut(docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR) -> DataFrame:
    """(kind, h, size, _id, _key, start, chunk): one row for each of pieces()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", SLICE_BYTES):
            out = [[] for _ in range(7)]
            for key, ident, text in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode()
                for kind, s, e, chunk in pieces(raw, window, divisor):
                    for column, x in zip(out, (kind, xxhash.xxh3_64_intdigest(raw[s:e]), e - s, ident, key, s, chunk)):
                        column.append(x)
            arrays = [pa.array(out[0], pa.int8()), pa.array(np.array(out[1], np.uint64).view(np.int64)), *(pa.array(x, pa.int64()) for x in out[2:])]
            yield pa.RecordBatch.from_arrays(arrays, ["kind", "h", "size", "_id", "_key", "start", "chunk"])

    return docs.filter("_id is not null and _text is not null").mapInArrow(run, "kind byte, h long, size long, _id long, _key long, start long, chunk long")


def of_bytes(text_col: str, f: Callable[[Column], Column]) -> Column:
    """f of a text's bytes, which are made once a text, not once for each use in f."""
    return F.element_at(F.transform(F.array(F.col(text_col).cast("string").cast("binary")), f), 1)


def part(raw: Column, start: Column, size: Column) -> Column:
    """`size` bytes from place `start`, counted from 0."""
    return F.substring(raw, (start + 1).cast("int"), size.cast("int"))


def repeated(docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR) -> DataFrame:
    """(_key, spans): the pieces (start, size), in order, to remove from each text of docs (_key, _id, _text)."""
    place = F.struct("_id", "_key", "start")
    found = staged(cut(docs, window, divisor).dropDuplicates(["_key", "start", "kind"]), "lines-pieces")
    # Rows of one hash can be a third of all, so copies are found by joins and combined minima, never gathered. The other
    # side is a table of its own, so that a join's skewed partitions can be split.
    common = lambda rows, what: staged(rows.groupBy("h", "size").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").select("h", "size", "first"), what)
    chunks = found.filter(F.col("kind") == CHUNK)
    chunks = staged(chunks.join(common(chunks, "lines-chunks"), ["h", "size"]).select("_key", "_id", "start", "size", (place != F.col("first")).alias("copy")), "lines-common-chunks")
    copies = chunks.filter("copy").select("_key", F.col("start").alias("chunk"))
    pairs = found.filter(F.col("kind") == PAIR).join(copies, ["_key", "chunk"], "left_anti")
    pairs = staged(pairs.select("h", "size", "_id", "_key", "start"), "lines-pairs")
    pairs = pairs.join(common(pairs, "lines-common"), ["h", "size"]).select("_key", "_id", "start", "size")
    meet = chunks.drop("copy").unionByName(pairs).groupBy("_key", "_id").agg(F.collect_list(F.struct("start", "size")).alias("spans"))
    body = lambda raw: F.transform("spans", lambda x: F.struct(x["start"].alias("start"), part(raw, x["start"], x["size"]).alias("body")))
    bodies = meet.join(docs.select("_key", "_text"), "_key").select("_key", "_id", F.inline(of_bytes("_text", body)))
    bodies = bodies.withColumns({"b": F.xxhash64("body"), "size": F.length("body")})
    bodies = staged(bodies.dropDuplicates(["_key", "start", "size"]), "lines-bodies")
    first = bodies.groupBy("body").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").select(F.xxhash64("body").alias("b"), F.length("body").alias("size"), "body", "first")
    first = staged(first, "lines-first")
    again = bodies.join(first.withColumnRenamed("body", "_body"), ["b", "size"])
    again = again.filter((F.col("body") == F.col("_body")) & (place != F.col("first")))
    return again.groupBy("_key").agg(F.sort_array(F.collect_set(F.struct("start", again["size"].alias("size")))).alias("spans"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, divisor: int = DIVISOR, counts: tuple[str, str] | None = None) -> DataFrame:
    """docs with the copies of runs of two or more lines taken out of their texts; counts: names for two more columns,
    the runs of lines taken out of a text and their bytes."""
    own, key, spans, starts, ends, left = fresh(docs, "_own", "_k", "_spans", "_starts", "_ends", "_left")
    gone = repeated(_rows(docs, id_col, text_col), window, divisor).withColumnsRenamed({"_key": key, "spans": spans})
    keyed = docs.withColumn(own, row_key(F.col(id_col).cast("long"), F.col(text_col).cast("string")))
    joined = keyed.join(gone, F.col(own) == F.col(key), "left")
    joined = joined.withColumns({starts: F.col(spans)["start"], ends: F.transform(spans, lambda x: x["start"] + x["size"])})

    def without(raw: Column) -> Column:
        # Spans lie in order by their starts and by their ends too: a chunk that goes has no other piece inside it.
        at = F.transform(ends, lambda e: e + F.when(part(raw, e, F.lit(1)) == F.lit(b"\n"), 1).otherwise(0))  # a piece goes with the newline after it
        at, to = F.concat(F.array(F.lit(0).cast("long")), at), F.concat(starts, F.array(F.length(raw).cast("long")))
        return F.array_join(F.zip_with(at, to, lambda s, e: part(raw, s, F.greatest(e - s, F.lit(0))).cast("string")), "")

    text = F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(of_bytes(text_col, without))
    if not counts:
        return joined.select(*(text.alias(c) if c == text_col else F.col(c) for c in docs.columns))
    before = F.concat(F.array(F.lit(-2).cast("long")), ends)
    new = F.filter(F.zip_with(starts, before, lambda s, e: s > e + 1), lambda x: x)
    n = F.size(new)
    out = joined.select(*docs.columns, text.alias(left), F.when(F.col(spans).isNull(), 0).otherwise(n).alias(counts[0]))
    return out.select(*(F.col(left).alias(c) if c == text_col else F.col(c) for c in docs.columns), counts[0], (F.octet_length(text_col) - F.octet_length(left)).alias(counts[1]))


def op10_lines(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_lines(docs, counts=("chunks", "bytes"))
    return out.select("doc_id", F.col("chunks").cast("long").alias("removed_chunks"), F.coalesce("bytes", F.lit(0)).cast("long").alias("removed_bytes"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
