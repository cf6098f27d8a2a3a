"""Language identification by rank-order n-gram profiles (out-of-place distance).

A text is reduced to lower-case words of letters; its n-grams of 1 to 5 letters, with the blank before and
after each word, are counted over the whole text and its `size` most frequent ones ranked (ties by the n-gram's
code). A language's profile is the same ranking over its training texts. The distance to a profile is the sum,
over the document's ranked n-grams, of the difference of ranks, or `size` where the profile lacks the n-gram;
the nearest profile wins (ties to the first name). n-grams are carried as 40-bit codes.

Profiles are fitted on a bounded, hash-chosen sample of `per_language` labelled texts of each language, in
expectation; every other step covers all rows and whole texts.

Defined cases: a null text, or one without a letter, is `und` with score 0, and so is every text when nothing
could be learned; null languages teach nothing; a row whose id is null is predicted, teaches nothing and is not
held out; repeated rows get one row each. Extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import crc_bucket, read_table, slices

UNKNOWN, SIZE, LONGEST, PER_LANGUAGE, CODE_BITS, BROADCAST_LANGUAGES, SLICE_BYTES = "und", 300, 5, 2000, 40, 10_000, 1 << 18


@functools.lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """By code point: the lower-case letter's code point, 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if (x := chr(c)).isalpha():
            table[c] = ord(x.lower()[0])
    return table


def ngrams(texts: list[str | None], longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """The owner (index of the text) and the code of every n-gram of every text."""
    texts = [x or "" for x in texts]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    points = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), lengths)
    s = letters()[points].astype(np.uint64)
    keep = s != 0
    keep[1:] |= s[:-1] != 0
    s, owner = s[keep], owner[keep]
    if len(s) and s[0]:  # the blank before the first word
        s, owner = np.concatenate([[np.uint64(0)], s]), np.concatenate([owner[:1], owner])
    blank = s == 0
    # A blank belongs to the word before it as an end, to the word after it as a start.
    first = owner.copy()
    if len(s):
        first[:-1][blank[:-1]] = owner[1:][blank[:-1]]
    owners, codes = [], []
    h, inner = s + np.uint64(1), np.ones(len(s), bool)
    for n in range(1, longest + 1):
        if n > 1:
            h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + s[n - 1 :] + np.uint64(1)
            inner = inner[:-1]
            if n > 2:
                inner = inner & ~blank[n - 2 : len(s) - 1]
        if not len(h):
            break
        ok = ~blank if n == 1 else inner  # two blanks are never next to each other
        mix = h[ok] ^ (h[ok] >> np.uint64(29))
        codes.append((mix * np.uint64(0xC4CEB9FE1A85EC53)) >> np.uint64(64 - CODE_BITS))
        owners.append(first[: len(h)][ok])
    if not codes:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(owners), np.concatenate(codes)


def counted(owner: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, code, count), by owner and code."""
    both = np.sort((owner.astype(np.uint64) << np.uint64(CODE_BITS)) | code)
    at = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.empty(0, np.int64)
    both, count = both[at], np.diff(np.append(at, len(both)))
    return (both >> np.uint64(CODE_BITS)).astype(np.int64), both & np.uint64((1 << CODE_BITS) - 1), count


def ranked(texts: list[str | None], size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, code, rank) of the most frequent n-grams of each text, ranks from 0."""
    owner, code, count = counted(*ngrams(texts))
    often = np.bincount(owner[count > 1], minlength=len(texts)) >= size
    keep = (count > 1) | ~often[owner]  # where enough n-grams repeat, one that does not cannot be ranked
    owner, code, count = owner[keep], code[keep], count[keep]
    top = np.int64(1) << 30
    order = np.argsort(owner * top + (top - 1 - np.minimum(count, top - 1)), kind="stable")
    owner, code = owner[order], code[order]
    starts = np.searchsorted(owner, np.arange(len(texts)))
    rank = np.arange(len(owner)) - starts[owner]
    keep = rank < size
    return owner[keep], code[keep], rank[keep]


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = SIZE, per_language: int = PER_LANGUAGE) -> dict[str, list[int]]:
    """{language: codes by rank}: at most `size` codes of each language reach the driver."""
    docs = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).filter("lang is not null and text is not null")
    counts = docs.groupBy("lang").count()
    if counts.count() <= BROADCAST_LANGUAGES:
        counts = F.broadcast(counts)
    part = docs.join(counts, "lang").filter(F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 30)) < F.lit(float(per_language)) / F.col("count") * (1 << 30)).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=SLICE_BYTES):
            names = batch.column(0).to_pylist()
            index = {x: i for i, x in enumerate(dict.fromkeys(names))}
            owner, code = ngrams(batch.column(1).to_pylist())
            lang = np.array([index[x] for x in names])[owner] if len(owner) else owner
            lang, code, count = counted(lang, code)
            yield pa.RecordBatch.from_arrays([pa.array(list(index)).take(pa.array(lang)), pa.array(code.astype(np.int64)), pa.array(count.astype(np.int64))], ["lang", "code", "n"])

    total = part.mapInArrow(run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    top = total.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))).filter(F.col("rank") <= size)
    profiles: dict[str, list[tuple[int, int]]] = {}
    for r in top.select("lang", "rank", "code").collect():
        profiles.setdefault(r.lang, []).append((r.rank, r.code))
    return {k: [c for _, c in sorted(profiles[k])] for k in sorted(profiles)}


def distances(texts: list[str | None], profiles: dict[str, list[int]], size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """The out-of-place distance of each text (row) to each profile (column), and each text's number of ranked n-grams."""
    owner, code, rank = ranked(texts, size)
    out = np.zeros((len(texts), len(profiles)))
    for j, codes in enumerate(profiles.values()):
        known = np.array(codes, np.uint64)
        order = np.argsort(known)
        at = np.minimum(np.searchsorted(known[order], code), len(known) - 1)
        gap = np.where(known[order][at] == code, np.abs(order[at] - rank), size)
        out[:, j] = np.bincount(owner, gap, len(texts))
    return out, np.bincount(owner, minlength=len(texts))


def predict(docs: DataFrame, profiles: dict[str, list[int]], text_col: str = "text", size: int = SIZE, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """docs with the predicted language and a score: 1 at no distance, 0 at the greatest."""
    known, at, columns = list(profiles), docs.columns.index(text_col), [*docs.columns, *names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, SLICE_BYTES):
            texts = batch.column(at).to_pylist()
            if known:
                gap, n = distances(texts, profiles, size)
                best = gap.argmin(axis=1)
                score = np.where(n > 0, 1 - gap[np.arange(len(texts)), best] / np.maximum(1, n * size), 0.0)
                found = [known[b] if k else UNKNOWN for b, k in zip(best, n > 0)]
            else:
                found, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array(score)], columns)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(names[0], StringType()), StructField(names[1], DoubleType())]))


def op5_langid(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = F.coalesce(crc_bucket(F.col("doc_id"), 3) == 1, F.lit(False))
    profiles = learn(docs.filter(F.col("doc_id").isNotNull() & ~held))
    out = predict(docs.select("doc_id", "text"), profiles)
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
