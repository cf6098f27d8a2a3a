"""Token counts kept under edits.

A document's state is its text and a segment tree over its pre-tokens: the leaves hold runs of pre-tokens with their
token counts, each node the characters, pre-tokens and tokens below it. keep() makes the table of states once, with the
lengths and counts of the pre-tokens in order; edit() takes such a table with edits and gives the table of the states
after them, which takes the next edits. An edit (at, drop, put) replaces `drop` characters at character `at` by `put`.
Splitting reads left to right and a pre-token depends on its own characters and two more at most, so the pre-tokens
that end two characters or more before the edit stay; from there the new text is split anew until a boundary behind
the edit falls on an old one, from which on all is as before. Only what lies between is encoded; the subtrees beside it
are kept and the sums on the way to the root are renewed.

Edits of a document apply in order, each to the text that the one before left. Positions beyond the end are the end,
negative ones the start. Defined cases: a null text is empty; null or no edits change nothing; a null put is empty;
repeated rows get one row each; extra columns are ignored. Special tokens count as ordinary text, so that counts can
differ from those of encode() where a text spells one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import _SPLIT, Codec, _codec, default_path, split
from .common import read_table, slices, staged

LEAF, REACH = 64, 2
STATE = "doc_id long, text string, lengths binary, counts binary"


class Node:
    """chars, items and tokens of a subtree; a leaf has lists of lengths and of counts, else there are two sides."""

    __slots__ = ("chars", "counts", "items", "left", "lengths", "right", "tokens")

    def __init__(self, lengths=None, counts=None, left=None, right=None):
        self.lengths, self.counts, self.left, self.right = lengths, counts, left, right
        if left is None:
            self.chars, self.items, self.tokens = sum(lengths), len(lengths), sum(counts)
        else:
            self.chars, self.items, self.tokens = left.chars + right.chars, left.items + right.items, left.tokens + right.tokens

    def leaves(self) -> Iterator[Node]:
        todo = [self]
        while todo:
            node = todo.pop()
            if node.left is None:
                yield node
            else:
                todo += (node.right, node.left)


def build(lengths: list[int], counts: list[int]) -> Node:
    level = [Node(lengths[i : i + LEAF], counts[i : i + LEAF]) for i in range(0, len(lengths), LEAF)] or [Node([], [])]
    while len(level) > 1:
        level = [Node(left=level[i], right=level[i + 1]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def before(node: Node, limit: int) -> int:
    """The start of the first pre-token that ends after `limit`, or the end of the text."""
    at = 0
    while node.left is not None:
        if at + node.left.chars > limit:
            node = node.left
        else:
            at += node.left.chars
            node = node.right
    for n in node.lengths:
        if at + n > limit:
            break
        at += n
    return at


def splice(node: Node, lo: int, hi: int, lengths: list[int], counts: list[int]) -> Node | None:
    """The tree with the pre-tokens that start in [lo, hi) replaced; lo and hi are boundaries. Subtrees beside them stay."""
    if node.left is None:
        at, i, j = 0, None, None
        for k, n in enumerate([*node.lengths, None]):
            if i is None and at >= lo:
                i = k
            if j is None and at >= hi:
                j = k
            at += n or 0
        i = len(node.lengths) if i is None else i
        j = len(node.lengths) if j is None else max(i, j)
        lengths = node.lengths[:i] + lengths + node.lengths[j:]
        return build(lengths, node.counts[:i] + counts + node.counts[j:]) if lengths else None
    middle = node.left.chars
    left, right = node.left, node.right
    if lo < middle or (lo == hi == middle):
        left = splice(left, lo, min(hi, middle), lengths, counts)
        if hi > middle:
            right = splice(right, 0, hi - middle, [], [])
    else:
        right = splice(right, lo - middle, hi - middle, lengths, counts)
    return Node(left=left, right=right) if left and right else left or right


def boundaries(node: Node, start: int, base: int = 0) -> Iterator[int]:
    """The pre-tokens' starts from `start` on, in order, then the end of the subtree."""
    if node.left is not None:
        if start < base + node.left.chars:
            yield from boundaries(node.left, start, base)
        yield from boundaries(node.right, start, base + node.left.chars)
        return
    for n in node.lengths:
        if base >= start:
            yield base
        base += n


class Document:
    def __init__(self, codec: Codec, text: str, lengths: list[int], counts: list[int]):
        self.codec, self.text, self.encoded, self.unknown = codec, text, 0, []
        self.tree = build(lengths, counts)

    def count(self, word: str) -> int:
        ids = self.codec.words.get(word)
        if ids is None:
            self.unknown.append(word)
            return 0
        return len(ids) // 4

    def edit(self, at: int, drop: int, put: str) -> None:
        at = min(max(at, 0), len(self.text))
        end = min(at + max(drop, 0), len(self.text))
        shift = len(put) - (end - at)
        lo = before(self.tree, at - REACH)
        text = self.text[:at] + put + self.text[end:]
        old, total = boundaries(self.tree, end), self.tree.chars
        known = next(old, total)
        lengths, counts, p = [], [], lo
        while p < len(text):
            while known + shift < p and known < total:
                known = next(old, total)
            if p >= at + len(put) and known + shift == p and known < total:
                break
            word = _SPLIT.match(text, p).group()
            lengths.append(len(word))
            counts.append(self.count(word))
            p += len(word)
        self.encoded += len(lengths)
        self.tree = splice(self.tree, lo, p - shift, lengths, counts) or build([], [])
        self.text = text


def _spec(docs: DataFrame, path: str | None):
    with open(path or default_path(), "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def keep(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, lengths, counts): the states of the documents, lengths and counts as little-endian 32-bit integers."""
    spec = _spec(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(spec.value)
        for part in slices(batches):
            texts = [x or "" for x in part.column("text").to_pylist()]
            words = [split(x) for x in texts]
            codec.learn(words)
            lengths = [np.fromiter(map(len, x), "<u4", len(x)).tobytes() for x in words]
            counts = [(np.fromiter(map(len, map(codec.words.__getitem__, x)), "<u4", len(x)) // 4).astype("<u4").tobytes() for x in words]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), pa.array(lengths, pa.binary()), pa.array(counts, pa.binary())], ["doc_id", "text", "lengths", "counts"])

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(run, STATE)


def edit(states: DataFrame, edits: str = "edits", path: str | None = None) -> DataFrame:
    """The states after the edits in the column `edits`, an array of structs (at, drop, put), with n_before, n_after,
    n_pretokens, n_encoded; n_encoded: pre-tokens encoded for the edits."""
    spec = _spec(states, path)

    def edited(codec: Codec, text: str, lengths: np.ndarray, counts: np.ndarray, changes: list[dict]) -> Document:
        d = Document(codec, text, lengths.tolist(), counts.tolist())
        for c in changes:
            d.edit(c["at"] or 0, c["drop"] or 0, c["put"] or "")
        return d

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(spec.value)
        for part in slices(batches):
            rows, unknown = [], []
            for ident, text, lengths, counts, changes in zip(*(c.to_pylist() for c in part.columns)):
                lengths, counts = np.frombuffer(lengths, "<u4"), np.frombuffer(counts, "<u4")
                d = edited(codec, text, lengths, counts, [c for c in changes or [] if c is not None])
                unknown += d.unknown
                rows.append([ident, text, lengths, counts, changes, d])
            # Where pre-tokens were met that are not known, these are encoded for all such texts together. Which
            # pre-tokens an edit meets does not depend on their counts, so that a second run knows all of them.
            if unknown:
                codec.learn([unknown])
            out = []
            for ident, text, lengths, counts, changes, d in rows:
                if d.unknown:
                    d = edited(codec, text, lengths, counts, [c for c in changes if c is not None])
                leaves = list(d.tree.leaves()) if d.encoded or d.text != text else []
                after = [np.array([x for n in leaves for x in getattr(n, k)], "<u4") if leaves else v for k, v in (("lengths", lengths), ("counts", counts))]
                out.append((ident, d.text, *(x.tobytes() for x in after), int(counts.sum()), d.tree.tokens, d.tree.items, d.encoded))
            kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for k, x in zip(kinds, zip(*out))], ["doc_id", "text", "lengths", "counts", "n_before", "n_after", "n_pretokens", "n_encoded"])

    return states.select("doc_id", "text", "lengths", "counts", F.col(edits).alias("edits")).mapInArrow(run, STATE + ", n_before long, n_after long, n_pretokens long, n_encoded long")


def with_edits(states: DataFrame, edits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """states with the column `edits` from a table (doc_id, seq, at, drop, put); a document's edits apply by seq."""
    own = edits.groupBy(F.col("doc_id").alias("_d")).agg(F.sort_array(F.collect_list(F.struct("seq", "at", "drop", "put"))).alias("edits"))
    return states.join(own, F.col(id_col) == F.col("_d"), "left").drop("_d")


def sample_edits(text: Column) -> Column:
    """The query's edits, made from each text: an insertion in the middle, a deletion at a third, a replacement near the end."""
    n = F.length(F.coalesce(text, F.lit("")))
    edit = lambda at, drop, put: F.struct(at.cast("int").alias("at"), F.lit(drop).alias("drop"), F.lit(put).alias("put"))
    return F.array(edit(F.floor(n / 2), 0, " inserted words"), edit(F.floor(n / 3), 7, ""), edit(n - 5, 3, "'ll  end\n"))


def op8_edits(spark, sf_dir: str) -> DataFrame:
    states = staged(keep(read_table(spark, sf_dir, "documents")), "edit-states")
    out = edit(states.withColumn("edits", sample_edits(F.col("text"))))
    return out.select("doc_id", "n_before", "n_after", "n_pretokens", "n_encoded", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
