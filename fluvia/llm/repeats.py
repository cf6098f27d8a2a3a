"""Suffix-array dedup: every byte covered by a string of `length` bytes that also starts elsewhere is found.

A column-wise construction inserts one symbol of each document a round, renews the sorted order of the suffixes (the
collection's Burrows-Wheeler transform) and the common prefixes of neighbours, and keeps both in files that are written
and read in sequence. As it stands it takes as many rounds as the longest document has bytes, each over all suffixes.
Only common prefixes of `length` bytes matter here, so the documents of the construction are pieces of the texts:
- In each window of `length` bytes the least of its grams of GRAM bytes (by hash, ties to the first) is its anchor.
  Windows in a row with one anchor make a piece; equal windows have equal anchors at the same place.
- Pieces are grouped by anchor and aligned at it. From the last column to the first, each piece puts its symbol of the
  column before its suffix; the order of the suffixes that start in the column is a stable sort of the last column's
  order by symbol, and the common prefix of two neighbours is one more than the least between them was. A window is
  repeated where its suffix has `length` bytes in common with a neighbour. Equal windows start in the same column, so
  no other column's suffixes have to be compared.
Of equal pieces (by 64-bit hashes of anchor and piece) two take part, so that copies too are found by their bytes; anchors
that occur once are dropped before any text moves. A group of more than `hot` pieces is split before it is gathered: a
window holds the anchor and at least half of what else it needs on one side of it, so each piece goes to the group of
those with the same bytes on the left and to that of those with the same bytes on the right, and so on while groups are
too large. Each step's table is written to the shared folder and read in sequence by the next.

Defined cases: a null text is empty; repeated rows are texts of their own, so they are removed as copies of each other;
null ids stay null; texts shorter than `length` stay whole. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joined_bytes, mixed, prefix_sums, read_table, slices, spans, staged

LENGTH, GRAM, HOT, BATCH_BYTES = 200, 32, 4096, 8 << 20
_PIECE = "k1 long, k2 long, start int, size int, off int, n int, anchor long, h long"


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` values in a row."""
    n = len(x) - width + 1
    rows = -(-len(x) // width)
    block = np.full(rows * width, np.iinfo(x.dtype).max, x.dtype)
    block[: len(x)] = x
    block = block.reshape(rows, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def pieces_of(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """The pieces of texts that lie one after the other in data: owner, start, size, off (of the anchor), n, anchor, h.

    n pieces in a row that are alike, as in periodic texts, are one entry.
    """
    kinds = {"owner": np.int64, "start": np.int32, "size": np.int32, "off": np.int32, "n": np.int32, "anchor": np.int64, "h": np.int64}
    if len(data) < length:
        return {k: np.empty(0, v) for k, v in kinds.items()}
    sums = prefix_sums(data)
    at = np.arange(len(data) - gram + 1)
    grams = spans(sums, at, at + gram)
    least = sliding_min((grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64), length - gram + 1)
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    owner = np.searchsorted(offsets, np.arange(len(data)), "right") - 1
    inside = owner[: len(anchor)] == owner[length - 1 :]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1 : len(anchor)] != owner[: len(anchor) - 1]) | (inside[1:] != inside[:-1])
    s = np.flatnonzero(new)
    e = np.append(s[1:], len(anchor))
    s, e = s[inside[s]], e[inside[s]]
    t, end = anchor[s], e - 1 + length
    out = {"owner": owner[s], "start": s - offsets[owner[s]], "size": end - s, "off": t - s, "anchor": grams[t].view(np.int64), "h": mixed(spans(sums, s, end) ^ grams[t]).view(np.int64)}
    first = np.ones(len(s), bool)
    first[1:] = (s[1:] != e[:-1]) | np.any([out[k][1:] != out[k][:-1] for k in ("owner", "size", "off", "anchor", "h")], axis=0)
    keep = np.flatnonzero(first)
    out = {k: v[keep] for k, v in out.items()} | {"n": np.diff(np.append(keep, len(s)))}
    return {k: out[k].astype(v) for k, v in kinds.items()}


def index(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """A row for each piece of docs (k1, k2, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = pieces_of(*joined_bytes(part.column(2)), length, gram)
            k = [np.asarray(part.column(i))[found["owner"]] for i in (0, 1)]
            names = ["start", "size", "off", "n", "anchor", "h"]
            yield pa.RecordBatch.from_arrays([*map(pa.array, k), *(pa.array(found[x]) for x in names)], ["k1", "k2", *names])

    return docs.mapInArrow(run, _PIECE)


def columns(group: np.ndarray, data: np.ndarray, starts: np.ndarray, size: np.ndarray, off: np.ndarray, length: int) -> np.ndarray:
    """For each piece and each of its windows, whether another piece of its group has the window in the same column.

    group: sorted; data[starts[i] : starts[i] + size[i]] are the bytes of piece i, off[i] is the anchor's place.
    """
    out = np.zeros((len(group), int(size.max()) - length + 1), bool)
    first, last = -off, size - off
    base = starts + off
    order, common = np.empty(0, np.int64), np.empty(0, np.int32)
    by_last = np.argsort(-last, kind="stable")
    begun, ends = 0, -last[by_last]
    for x in range(int(last.max()) - 1, int(first.min()) - 1, -1):
        stop = int(np.searchsorted(ends, -x - 1, "right"))
        if stop > begun:  # their suffixes are empty: they come first in their groups
            order = np.concatenate([by_last[begun:stop], order])
            common = np.concatenate([np.zeros(stop - begun, np.int32), common])
            place = np.argsort(group[order], kind="stable")
            order, common, begun = order[place], common[place], stop
        live = first[order] <= x
        if not live.all():  # the least common prefix over those that went
            stay = np.flatnonzero(live)
            if not len(stay):
                order, common = order[:0], common[:0]
                continue
            common = np.minimum.reduceat(common, np.concatenate([[0], stay[:-1] + 1]))
            order = order[stay]
        if not len(order):
            continue
        key = group[order] * 256 + data[base[order] + x]
        place = np.argsort(key, kind="stable")
        key = key[place]
        same = np.flatnonzero(key[1:] == key[:-1]) + 1
        new = np.zeros(len(order), np.int32)
        if len(same):
            bounds = np.empty(2 * len(same), np.int64)
            bounds[::2], bounds[1::2] = place[same - 1] + 1, place[same] + 1
            new[same] = np.minimum.reduceat(np.append(common, 0), bounds)[::2] + 1
        order, common = order[place], new
        met = common >= length
        if met.any():
            met[:-1] |= met[1:]
            who = order[met]
            out[who, x - first[who]] = True
    return out


def repeated_windows(pieces: DataFrame, length: int, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(anchor, h, bits): the windows, one bit each, of pieces (g, anchor, h, copy, off, body) that others of their group g
    have too; bits null: all. Copies' own are left out: theirs are the pieces'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size > batch_bytes:  # all groups but the last, which may go on
                whole = pa.Table.from_batches(held).combine_chunks()
                groups = whole.column("g").to_numpy()
                cut = int(np.searchsorted(groups, groups[-1]))
                if cut:
                    yield from done(whole.slice(0, cut))
                held = whole.slice(cut).to_batches()
                size = sum(x.nbytes for x in held) if cut else 0
        if held:
            yield from done(pa.Table.from_batches(held))

    def done(whole: pa.Table) -> Iterator[pa.RecordBatch]:
        whole = whole.combine_chunks()
        if not whole.num_rows:
            return
        _, group = np.unique(whole.column("g").to_numpy(), return_inverse=True)
        data, offsets = joined_bytes(whole.column("body").chunk(0))
        size = np.diff(offsets)
        met = columns(group, data, offsets[:-1], size, whole.column("off").to_numpy().astype(np.int64), length)
        some = np.flatnonzero(met.any(axis=1) & ~np.asarray(whole.column("copy")))
        every = met[some].sum(axis=1) == size[some] - length + 1
        bits = [None if e else x.tobytes() for e, x in zip(every.tolist(), np.packbits(met[some], axis=1))]
        table = whole.take(pa.array(some))
        for a, h, b in zip(*(c.chunks for c in pa.table({"anchor": table.column("anchor").combine_chunks(), "h": table.column("h").combine_chunks(), "bits": pa.array(bits, pa.binary())}).columns)):
            yield pa.RecordBatch.from_arrays([a, h, b], ["anchor", "h", "bits"])

    rows = pieces.select("g", "anchor", "h", "copy", "off", "body").repartition("g").sortWithinPartitions("g", "h")
    return rows.mapInArrow(run, "anchor long, h long, bits binary")


def windows_by_groups(pieces: DataFrame, length: int, gram: int, hot: int, batch_bytes: int) -> DataFrame:
    """repeated_windows() of pieces grouped by anchor, large groups split. lo, hi: what a group shares around the anchor."""
    rows = pieces.select(F.col("anchor").alias("g"), "*", F.lit(0).alias("lo"), F.lit(gram).alias("hi"))
    out = None
    while True:
        sizes = staged(rows.groupBy("g").agg(F.count("*").alias("c")).filter(F.col("c") > hot).select("g"), "repeats-large")
        some = not sizes.isEmpty()
        small = rows.join(sizes, "g", "left_anti") if some else rows
        found = repeated_windows(small, length, batch_bytes)
        out = found if out is None else out.unionByName(found)
        if not some:
            return out
        large = rows.join(sizes, "g")
        need = F.lit(length) - (F.col("hi") - F.col("lo"))
        # Groups that share a whole window: their pieces have it if others of the very same bytes do.
        whole = large.filter(need <= 0).withColumn("at", F.col("off") + F.col("lo")).withColumn("own", F.substring("body", F.col("at") + 1, F.lit(length)))
        twice = staged(whole.groupBy("g", "own").agg(F.count("*").alias("c")).filter("c > 1").select("g", "own"), "repeats-whole")
        bit = F.expr("unhex(concat(repeat('00', int(at / 8)), lpad(hex(shiftright(128, at % 8)), 2, '0')))")
        out = out.unionByName(whole.join(twice, ["g", "own"]).filter("not copy").select("anchor", "h", bit.alias("bits")))
        half = F.ceil(need / 2).cast("int")
        sides = F.array(F.struct((F.col("lo") - half).alias("lo"), F.col("hi").alias("hi")), F.struct(F.col("lo").alias("lo"), (F.col("hi") + half).alias("hi")))
        split = large.filter(need > 0).withColumn("side", F.explode(sides)).drop("lo", "hi").select("*", "side.lo", "side.hi").drop("side")
        split = split.filter((F.col("off") + F.col("lo") >= 0) & (F.col("off") + F.col("hi") <= F.octet_length("body")))
        shared = F.substring("body", F.col("off") + F.col("lo") + 1, F.col("hi") - F.col("lo"))
        rows = staged(split.withColumn("g", F.xxhash64("g", "lo", "hi", shared)), "repeats-split")


def bodies(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(anchor, h, off, copy, body): the bytes of the pieces wanted (k1, k2, anchor, h, start, size, off, copy)."""
    per = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("anchor", "h", "start", "size", "off", "copy")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            wanted = part.column("wanted")
            flat, bounds = wanted.flatten(), np.asarray(wanted.offsets)[: len(wanted) + 1]
            data, offsets = joined_bytes(part.column("text"))
            start, size = (np.asarray(flat.field(x)) for x in ("start", "size"))
            at = np.repeat(offsets[:-1], np.diff(bounds)) + start
            ends = np.concatenate([[0], np.cumsum(size)])
            own = np.arange(ends[-1]) + np.repeat(at - ends[:-1], size)
            body = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[own])])
            yield pa.RecordBatch.from_arrays([flat.field("anchor"), flat.field("h"), flat.field("off"), flat.field("copy"), body], ["anchor", "h", "off", "copy", "body"])

    return docs.join(per, ["k1", "k2"]).select("text", "wanted").mapInArrow(run, "anchor long, h long, off int, copy boolean, body binary")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return docs.select("doc_id", F.xxhash64("doc_id").alias("k1"), F.xxhash64("text").alias("k2"), "text")


def found(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(k1, k2, runs): the repeated windows of each text that has some, by pieces (start, size, n, bits); bits null: all."""
    pieces = staged(index(docs.select("k1", "k2", "text"), length, gram), "repeats-pieces")
    anchors = pieces.groupBy("anchor").agg(F.sum("n").alias("c")).filter("c > 1").drop("c")
    live = staged(pieces.join(staged(anchors, "repeats-anchors"), "anchor"), "repeats-live")
    place = F.struct("k1", "k2", "start", "size", "off", "n")
    kinds = live.groupBy("anchor", "h").agg(F.sum("n").alias("c"), F.min(place).alias("p"), F.max(place).alias("q"))
    # The copy is the last one, or where that is the first, the next of a run of alike pieces, or another row of that text.
    same = (F.col("p") == F.col("q")) & (F.col("p.n") > 1)
    start = F.col("q.start") + F.when(same, F.col("q.size") - length + 1).otherwise(0)
    copy = F.struct("q.k1", "q.k2", start.cast("int").alias("start"), "q.size", "q.off", F.lit(True).alias("copy"))
    both = F.array(F.struct("p.k1", "p.k2", "p.start", "p.size", "p.off", F.lit(False).alias("copy")), F.when(F.col("c") > 1, copy))
    wanted = kinds.select("anchor", "h", F.explode(F.array_compact(both)).alias("x")).select("anchor", "h", "x.*")
    own = staged(bodies(docs, wanted).dropDuplicates(["anchor", "h", "copy"]), "repeats-bodies")
    verdicts = staged(windows_by_groups(own, length, gram, hot, batch_bytes), "repeats-verdicts")
    hits = live.join(verdicts, ["anchor", "h"]).select("k1", "k2", "start", "size", "n", "bits")
    # Rows of one id and text have equal runs: as a set they are no more than one row's.
    return hits.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "size", "n", "bits")).alias("runs"))


def covered(n_bytes: int, runs: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """The maximal runs of bytes in repeated windows."""
    change = np.zeros(n_bytes + 1, np.int32)
    for r in runs or []:
        windows = r["size"] - length + 1
        if r["bits"] is None:
            change[r["start"]] += 1
            change[r["start"] + r["n"] * windows + length - 1] -= 1
            continue
        step = np.diff(np.unpackbits(np.frombuffer(r["bits"], np.uint8))[:windows].astype(np.int8), prepend=0, append=0)
        for k in range(r["n"]):
            at = r["start"] + k * windows
            np.add.at(change, at + np.flatnonzero(step == 1), 1)
            np.add.at(change, np.minimum(at + np.flatnonzero(step == -1) + length - 1, n_bytes), -1)
    on = (np.cumsum(change)[:n_bytes] > 0).astype(np.int8)
    edge = np.diff(on, prepend=0, append=0)
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: the removed runs of bytes [start, end) and the bytes left."""
    keyed = _keyed(docs, id_col, text_col)
    runs = staged(found(keyed, length, gram, hot, batch_bytes), "repeats-runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sizes, cut, kept = [], [], []
            for text, own in zip(part.column("text").to_pylist(), part.column("runs").to_pylist()):
                raw = text.encode()
                gone = covered(len(raw), own, length)
                ends = [0, *(x for s in gone for x in s), len(raw)]
                sizes.append(len(raw))
                cut.append([{"start": s, "end": e} for s, e in gone])
                kept.append(b"".join(raw[s:e] for s, e in zip(ends[::2], ends[1::2])))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(cut, span), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    joined = keyed.join(runs, ["k1", "k2"], "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def op1_repeats(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
