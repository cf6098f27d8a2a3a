"""Spelling variants by wildcard groups: no pairs of words are made.

Two words are near if they differ by exactly one replaced, inserted or deleted code point. Each word is sent to one group
for each of its places, keyed by (place, what stands before, what stands after): all words of a group are near each
other by a replacement there. Each of a word's different deletions is sent to the group of that string, where the word
of that spelling, if there is one, waits: it is near all the deletions' words. A group is read once, in order: its size
and its first two words give each member the number of its near words there and the best of these, so that a group
costs its length; a word's groups are then combined by a sum and a minimum. No two groups hold the same two words.

A group's key is the string itself (with a wildcard letter for a replacement) as a polynomial modulo 2**127 - 1, which
takes constant time a place; two strings with one key are taken as equal (at 10**12 keys the chance of any such two is
below 10**-13). A replacement's group has as many words as there are letters at most, a deletion's as many as letters by
places, so none grows with the corpus. Words are numbered in order of falling count, then of code points: the best near
word is the one of the least number.

A word's form is its best near word, if that occurs RATIO times as often at least; its root is where the forms lead. As
counts grow by that ratio at each step, forms make no cycle and chains are short; roots are found by doubling pointers.

Defined cases: null texts have no words, a null id counts as an empty one; repeated rows count once each; an empty table
gives none; words of any length are whole; extra columns are ignored. A table of words may have a word in several rows,
whose counts add up; null words take no part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, slices, staged

LEAST_LETTERS, LEAST_COUNT, RATIO, TYPO_EVERY = 7, 2, 10, 31
P, BASE = (1 << 127) - 1, 0x5851F42D4C957F2D14057B7EF767814F
BACK = pow(BASE, -1, P)
WILD = 0x110001  # one over the greatest letter, which are counted from 1
ROWS = 1 << 16
WORD, DELETION, REPLACEMENT = 0, 1, 2


def typed(doc_id: int | None, words: Counter, every: int) -> Counter:
    """The words of one document with the letters deleted that the contract's crc32 picks; every = 0: as they are."""
    if not every:
        return words
    out, before = Counter(), zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for w, n in words.items():
        h = zlib.crc32(w.encode(), before)
        if h % every == 0:
            at = h % len(w)
            w = w[:at] + w[at + 1 :]
        out[w] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS, typo_every: int = 0) -> DataFrame:
    """(word, n) of the runs of letters of whole texts, with A-Z lower-cased, that have least_letters at least."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % max(1, least_letters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, max_bytes=8 << 20):
            total = Counter()
            for ident, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if text:
                    # The letters of A-Z are single bytes of UTF-8, and bytes.lower() changes no others.
                    total.update(typed(ident, Counter(runs.findall(text.encode().lower().decode())), typo_every))
            found = [(w, n) for w, n in total.items() if len(w) >= least_letters]
            if found:
                words, counts = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def keys(word: str, least_letters: int) -> Iterator[tuple[int, int]]:
    """(kind, key) of a word, of its wildcard groups, and of its different deletions of least_letters at least."""
    letters = [ord(c) + 1 for c in word]
    before, power, powers = [0], 1, []
    for c in letters:
        before.append((before[-1] + c * power) % P)
        powers.append(power)
        power = power * BASE % P
    whole = before[-1]
    yield WORD, whole
    for c, power in zip(letters, powers):
        yield REPLACEMENT, (whole + (WILD - c) * power) % P
    if len(letters) > least_letters:
        last = 0
        for i, c in enumerate(letters):
            if c != last:  # of equal letters in a row each deletion gives the same string
                yield DELETION, (before[i] + (whole - before[i + 1]) * BACK) % P
            last = c


def grouped_keys(words: DataFrame, least_letters: int = LEAST_LETTERS) -> DataFrame:
    """(a, b, kind, rank): the groups (a, b) of each row (word, rank)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(raw: list[bytes], kinds: list[int], ranks: list[int]) -> pa.RecordBatch:
            key = np.frombuffer(b"".join(raw), "<i8").reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(key[:, 0]), pa.array(key[:, 1]), pa.array(kinds, pa.int8()), pa.array(ranks, pa.int64())], ["a", "b", "kind", "rank"])

        raw, kinds, ranks = [], [], []
        for batch in batches:
            for word, rank in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for kind, key in keys(word, least_letters):
                    raw.append(key.to_bytes(16, "little"))
                    kinds.append(kind)
                    ranks.append(rank)
                    if len(raw) >= ROWS:
                        yield table(raw, kinds, ranks)
                        raw, kinds, ranks = [], [], []
        yield table(raw, kinds, ranks)

    return words.select("word", "rank").mapInArrow(run, "a long, b long, kind byte, rank long")


def members(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(rank, near, best) of whole groups in rows (a, b, kind, rank) in order, and where the last group starts."""
    a, b, kind, rank = columns
    bounds = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(1, np.int64)
    size = np.diff(np.append(bounds, len(a)))
    told = (size > 1) & (kind[bounds] != DELETION) if len(a) else np.zeros(1, bool)
    size, start = size[told], bounds[told]
    n = np.repeat(size, size)
    at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(len(n))
    first = np.repeat(start, size)
    near = np.where((kind[first] == REPLACEMENT) | (at == first), n - 1, 1)
    return rank[at], near, np.where(at == first, rank[np.minimum(first + 1, max(len(rank) - 1, 0))], rank[first]), int(bounds[-1])


def near_words(groups: DataFrame) -> DataFrame:
    """(rank, n_near, best) of the words with near words, from grouped_keys()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(rank, near, best):
            return pa.RecordBatch.from_arrays([pa.array(rank), pa.array(near.astype(np.int64)), pa.array(best)], ["rank", "near", "best"])

        held: list[np.ndarray] | None = None
        for batch in batches:
            if batch.num_rows:
                columns = [np.asarray(c) for c in batch.columns]
                columns = [np.concatenate(x) for x in zip(held, columns)] if held else columns
                *_, last = members(columns)  # the last group may go on in the next batch
                rank, near, best, _ = members([c[:last] for c in columns])
                held = [c[last:] for c in columns]
                if len(rank):
                    yield told(rank, near, best)
        if held:
            yield told(*members(held)[:3])

    ordered = groups.repartition("a", "b").sortWithinPartitions("a", "b", "kind", "rank")
    found = ordered.mapInArrow(run, "rank long, near long, best long")
    return found.groupBy("rank").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(rank, root) from (rank, up): where following up leads, by doubling; up must lead to no cycle."""
    now = staged(forms.select("rank", "up"), "variants-roots")
    while True:
        more = now.select(F.col("rank").alias("up"), F.col("up").alias("next"))
        step = staged(now.join(more, "up", "left").select("rank", F.coalesce("next", "up").alias("up"), F.col("next").isNotNull().alias("moved")), "variants-roots")
        now = step.select("rank", "up")
        if step.filter("moved").isEmpty():
            return now.withColumnRenamed("up", "root")


def group_variants(words: DataFrame, word_col: str = "word", count_col: str = "n", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of a table (word, n) with letters and counts enough."""
    words = words.select(F.col(word_col).alias("word"), F.col(count_col).cast("long").alias("n")).filter("word is not null")
    words = words.groupBy("word").agg(F.sum("n").alias("n")).filter((F.length("word") >= least_letters) & (F.col("n") >= least_count))
    # Numbers follow the order: partitions and their rows stand in it.
    known = staged(words.orderBy(F.desc("n"), "word").withColumn("rank", F.monotonically_increasing_id()), "variants-words")
    near = near_words(grouped_keys(known, least_letters))
    best = known.select(F.col("rank").alias("best"), F.col("word").alias("best_word"), F.col("n").alias("best_n"))
    near = staged(near.join(known, "rank").join(best, "best").withColumn("has", F.col("best_n") >= ratio * F.col("n")), "variants-near")
    up = roots(near.filter("has").select("rank", F.col("best").alias("up")))
    named = up.join(known.select(F.col("rank").alias("root"), F.col("word").alias("root_word")), "root").select("rank", "root_word")
    told = near.select("rank", "n_near", *(F.when(F.col("has"), F.col(c)).alias(to) for c, to in (("best_word", "form"), ("best_n", "form_n"))))
    out = known.join(told, "rank", "left").join(named, "rank", "left")
    return out.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def op12_variants(spark, sf_dir: str) -> DataFrame:
    return group_variants(word_counts(read_table(spark, sf_dir, "documents"), typo_every=TYPO_EVERY))
