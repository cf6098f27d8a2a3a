"""Language-model scoring by Katz backoff over word trigrams.

Tokens are the words of a text (A-Z lower-cased), then one end. Counts come from the training texts. Counts up to
CUTOFF are discounted by Good-Turing ratios (by an absolute discount where the counts of counts give no valid ratios),
and what they give up goes to what was not seen, order by order:
- P(w) = f * d(c) * c / N for a word seen, the rest for the unknown word, one class as in the baseline;
- P(w | v) = f(v) * d(c) * c(v, w) / c(v) for a pair seen, else a(v) * P(w);
- P(w | u v) = f(u v) * d(c) * c(u, v, w) / c(u, v) for a triple seen, else a(u v) * P(w | v),
with a() such that each P(. | history) adds up to 1, and 1 for a history never seen. f is 1, but where no count is
discounted (then one count's share is kept back). Before a text's first word stands the end, alone: that word has no
triple. No vocabulary is cut off: every word taught has counts, pairs and triples of its own.

Texts are read in slices of about `slice_bytes`, each a row of the table "katz-slices". Words are counted in a table
partitioned by their hash, which answers each slice with its words' counts and places among equal counts; from the
counts of counts these give every word a number from which its count can be read off. A slice then posts each token with
the two before it to the bucket of the token before (v). That bucket holds all pairs and triples around v, so one task
has all that P(w | u v) needs, and gives back sums per document. Words v that are more than 1 / SPLIT of all tokens (or
half a bucket's share, if that is less) are dealt by (v, u) instead; their pairs are added up in a table partitioned by
pair, and the bucket asks for them. A history (u, v) is never split. There are so many buckets that each holds about
`bucket_bytes` of text, `least_buckets` at least.

Reaching the driver: how many words have each count (at most sqrt(2 N) different counts), counts of counts up to CUTOFF
+ 1, and a row of sums for each split word (SPLIT or 2 * buckets of them at most).

Defined cases: a null or empty text has one token, its end; a row whose id is null is scored, is not held out and
teaches nothing; repeated rows count and are returned as often as they occur; with nothing to learn from, every score is
0. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed_table, crc_bucket, mixed, read_table, slices, staged

CUTOFF, SLICE_BYTES, BUCKET_BYTES, LEAST_BUCKETS, SPLIT, LEVEL = 5, 8 << 20, 10 << 20, 64, 1024, 3
NONE = 0xFFFFFFFF  # in place of the word before a text's first history


class _Index(dict):
    """The number of each word in order of its first use; the empty string stands for the end."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def pack(values: np.ndarray, differences: bool = False) -> bytes:
    """Numbers as their bytes by place, compressed. differences: of each to the one before, for sorted integers."""
    d = np.diff(values, prepend=values.dtype.type(0)) if differences else values
    return zstandard.compress(np.ascontiguousarray(np.ascontiguousarray(d).view(np.uint8).reshape(-1, values.dtype.itemsize).T).tobytes(), LEVEL)


def unpack(data: bytes, kind, differences: bool = False) -> np.ndarray:
    size = np.dtype(kind).itemsize
    out = np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(size, -1).T).view(kind).ravel()
    return np.cumsum(out, dtype=kind) if differences else out


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((mixed(keys.astype(np.uint64)) >> np.uint64(8)) % np.uint64(buckets)).astype(np.int64)


def cuts(own: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order of rows by bucket (own), and (bucket, start, end) of each that has rows in that order."""
    order = np.argsort(own, kind="stable")
    bounds = np.searchsorted(own[order], np.arange(buckets + 1))
    return order, [(b, int(bounds[b]), int(bounds[b + 1])) for b in np.flatnonzero(np.diff(bounds)).tolist()]


def read_slices(docs: DataFrame, buckets: int, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """docs (doc_id, text, held_out, teaches) as slices: the hashes of their distinct words, by bucket, and how often each
    is taught; the place of each token's word among them; each text's end in tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = TaskContext.get().partitionId() << 32
        for part in _gathered(batches, slice_bytes):
            index, rows, lengths = _Index({b"": 0}), [], []
            for text in part.column("text").to_pylist():
                words = (text or "").encode().lower().split()
                lengths.append(len(words) + 1)
                rows.append(np.fromiter(map(index.__getitem__, words), np.uint32, len(words)))
                rows.append(np.zeros(1, np.uint32))
            tokens = np.concatenate(rows)
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, index), np.uint64, len(index))
            order = np.lexsort((hashes, bucket_of(hashes, buckets)))
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            tokens = place[tokens]
            teaches = np.array(part.column("teaches").to_pylist(), bool)
            taught = np.bincount(tokens[np.repeat(teaches, lengths)], minlength=len(index)).astype(np.uint32)
            row = {"slice": n, "ids": part.column("doc_id").to_pylist(), "held_out": part.column("held_out").to_pylist(), "teaches": teaches.tolist()}
            row |= {"words": pack(hashes[order]), "taught": pack(taught), "tokens": pack(tokens), "ends": pack(np.cumsum(lengths).astype(np.uint64), True)}
            yield pa.RecordBatch.from_pylist([row], _SLICE)
            n += 1

    return docs.select("doc_id", "text", "held_out", "teaches").mapInArrow(run, "slice long, ids array<long>, held_out array<boolean>, teaches array<boolean>, words binary, taught binary, tokens binary, ends binary")


_SLICE = pa.schema([("slice", pa.int64()), ("ids", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("teaches", pa.list_(pa.bool_())), *((k, pa.binary()) for k in ("words", "taught", "tokens", "ends"))])


def _gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for part in slices(batches, "text", most):
        own = part.nbytes
        if held and size + own > most:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        held.append(part)
        size += own
    if held:
        yield pa.Table.from_batches(held)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def count_words(parts: DataFrame, buckets: int) -> DataFrame:
    """(bucket, slice, counts, places) for each slice's words of the bucket, in order: how often they are taught, and
    their places among the bucket's words of that count; slice null, counts and places: the different counts and how
    many words have each."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            hashes, taught = unpack(row["words"], np.uint64), unpack(row["taught"], np.uint32)
            own = bucket_of(hashes, buckets)
            bounds = np.searchsorted(own, np.arange(buckets + 1))
            cut = [(b, bounds[b], bounds[b + 1]) for b in np.flatnonzero(np.diff(bounds)).tolist()]
            columns = [pa.array([b for b, _, _ in cut], pa.int64()), pa.array([row["slice"]] * len(cut), pa.int64()), *(pa.array([pack(x[s:e], d) for _, s, e in cut], pa.binary()) for x, d in ((hashes, True), (taught, False)))]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "slice", "words", "taught"])

    def run(group: pa.Table) -> pa.Table:
        words = [unpack(x, np.uint64, True) for x in group.column("words").to_pylist()]
        taught = [unpack(x, np.uint32) for x in group.column("taught").to_pylist()]
        found, at = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(at, np.concatenate(taught).astype(float), len(found)).astype(np.uint64)
        order = np.argsort(total, kind="stable")
        kinds, first, many = np.unique(total[order], return_index=True, return_counts=True)
        place = np.empty(len(found), np.uint32)
        place[order] = np.arange(len(found)) - np.repeat(first, many)
        ends = np.cumsum([0, *map(len, words)])
        own = [at[s:e] for s, e in zip(ends, ends[1:])]
        return pa.table({
            "bucket": pa.array([group.column("bucket")[0].as_py()] * (len(own) + 1), pa.int64()),
            "slice": pa.array([*group.column("slice").to_pylist(), None], pa.int64()),
            "counts": pa.array([*(pack(total[x]) for x in own), pack(kinds)], pa.binary()),
            "places": pa.array([*(pack(place[x]) for x in own), pack(many.astype(np.uint32))], pa.binary()),
        })

    posted = parts.select("slice", "words", "taught").mapInArrow(post, "bucket long, slice long, words binary, taught binary")
    return posted.groupBy("bucket").applyInArrow(run, "bucket long, slice long, counts binary, places binary")


def discounts(n: list[int], cutoff: int = CUTOFF) -> np.ndarray:
    """d(c) * c for counts 0 .. cutoff by Good-Turing, or c less an absolute discount where that gives no valid ratio.
    n: how many have count r, for r = 0 .. cutoff + 1."""
    out = np.arange(cutoff + 1, dtype=float)
    if all(n[1:]):
        top = (cutoff + 1) * n[cutoff + 1] / n[1]
        ratios = [((r + 1) * n[r + 1] / (r * n[r]) - top) / (1 - top) if top != 1 else 0.0 for r in range(1, cutoff + 1)]
        if all(0 < d < 1 for d in ratios):
            out[1:] *= ratios
            return out
    out[1:] -= n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    return out


def discounted(n: np.ndarray, small: np.ndarray) -> np.ndarray:
    return np.where(n < len(small), small[np.minimum(n, len(small) - 1).astype(np.int64)], n.astype(float))


def leftover(n: np.ndarray, kept: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """f / n and a() of histories with n counts, of which discounts leave `kept`; prior: what was seen has by the lower
    order. 0 and 1 where n is 0."""
    some = np.maximum(n, 1)
    held = kept / some
    f = np.where(held < 1 - 1e-12, 1.0, n / (n + 1) / np.maximum(held, 1e-300))
    return np.where(n > 0, f / some, 0.0), np.where(n > 0, np.maximum(1 - f * held, 1e-300) / np.maximum(1 - prior, 1e-300), 1.0)


@dataclass
class Words:
    """Numbers of words by falling count: those of counts[i] are from starts[i] on."""

    counts: np.ndarray
    starts: np.ndarray
    tokens: int
    distinct: int
    prior: np.ndarray  # P(w) of words of each count
    buckets: int
    small: dict[int, np.ndarray] = field(default_factory=dict)  # d(c) * c of pairs (2) and triples (3)
    split: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # words dealt by (v, u), by number
    split_sums: np.ndarray = field(default_factory=lambda: np.empty((2, 0)))  # kept, prior of these

    def number(self, counts: np.ndarray, places: np.ndarray, bucket: int) -> np.ndarray:
        return self.starts[len(self.counts) - 1 - np.searchsorted(self.counts[::-1], counts)] + places.astype(np.int64) * self.buckets + bucket

    def level(self, numbers: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, numbers, "right") - 1

    def hot(self, numbers: np.ndarray) -> np.ndarray:
        return self.counts[self.level(numbers)].astype(float) * max(SPLIT, 2 * self.buckets) > self.tokens


def numbered(words: DataFrame, buckets: int, cutoff: int = CUTOFF) -> Words:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            yield pa.RecordBatch.from_arrays([pa.array(unpack(row["counts"], np.uint64).astype(np.int64)), pa.array(unpack(row["places"], np.uint32).astype(np.int64))], ["c", "words"])

    per = words.filter("slice is null").select("counts", "places").mapInArrow(run, "c long, words long")
    rows = sorted((r.c, r.n, r.most) for r in per.groupBy("c").agg(F.sum("words").alias("n"), F.max("words").alias("most")).collect())[::-1]
    counts, n, most = (np.array([r[i] for r in rows], np.int64) for i in range(3))
    starts = np.cumsum(most * buckets) - most * buckets
    if len(rows) and starts[-1] + most[-1] * buckets >= NONE:
        raise OverflowError("more words than 32 bits can number")
    tokens, distinct = int((counts * n).sum()), int(n[counts > 0].sum())
    by = dict(zip(counts.tolist(), n.tolist()))
    small = discounts([by.get(r, 0) for r in range(cutoff + 2)], cutoff)
    kept = discounted(counts, small)
    held = float((kept * n)[counts > 0].sum()) / max(tokens, 1)
    f = 1.0 if held < 1 - 1e-12 else tokens / (tokens + 1) / held
    return Words(counts, starts, tokens, distinct, np.where(counts > 0, f / max(tokens, 1) * kept, 1 - f * held), buckets)


_POST = [("bucket", pa.int64()), ("slice", pa.int64()), ("docs", pa.binary()), ("v", pa.binary()), ("u", pa.binary()), ("w", pa.binary()), ("ids", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("n_tokens", pa.list_(pa.int64())), ("n_known", pa.list_(pa.int64())), ("base", pa.list_(pa.float64()))]
_POST_SQL = "bucket long, slice long, docs binary, v binary, u binary, w binary, ids array<long>, held_out array<boolean>, n_tokens array<long>, n_known array<long>, base array<double>"


def post_tokens(parts: DataFrame, words: DataFrame, model: Words) -> DataFrame:
    """Rows (bucket, slice, docs, v, u, w): the slice's tokens w after u v that the bucket deals with; docs: twice the
    text's place in the slice, and one if it teaches. One row a slice, without tokens, has the texts' ids and base
    scores instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            numbers = np.concatenate([model.number(unpack(x["counts"], np.uint64), unpack(x["places"], np.uint32), x["bucket"]) for x in sorted(row["answers"], key=lambda x: x["bucket"])])
            w, ends = numbers[unpack(row["tokens"], np.uint32)], unpack(row["ends"], np.uint64, True).astype(np.int64)
            starts = np.append(0, ends[:-1])
            docs = np.repeat(np.arange(len(ends)) * 2 + np.array(row["teaches"], np.int64), ends - starts)
            v, u = np.append(0, w[:-1]), np.concatenate([[0, 0], w[:-2]])[: len(w)]
            v[starts] = w[ends[0] - 1]
            second = starts[ends - starts > 1] + 1
            u[second], u[starts] = w[ends[0] - 1], NONE
            hot = model.hot(v)
            # Where no triple is, the pair may go anywhere.
            deal = np.where(hot, v * 0x9E3779B1 + np.where(u == NONE, w + 1, u) * 0x85EBCA77, v)
            order, cut = cuts(bucket_of(deal, model.buckets), model.buckets)
            docs, v, u, w = docs[order].astype(np.uint32), v[order].astype(np.uint32), u[order].astype(np.uint32), w[order]
            level = model.level(w)
            c = model.counts[level]
            own = docs >> 1
            base = np.bincount(own, np.log10((c + 0.1) / (model.tokens + 0.1 * (model.distinct + 1))), len(ends))
            known = np.bincount(own, c > 0, len(ends)).astype(np.int64)
            rows = [{"bucket": b, "slice": row["slice"], "docs": pack(docs[s:e], True), "v": pack(v[s:e]), "u": pack(u[s:e]), "w": pack(w[s:e].astype(np.uint32))} for b, s, e in cut]
            rows.append({"bucket": row["slice"] % model.buckets, "slice": row["slice"], "ids": row["ids"], "held_out": row["held_out"], "n_tokens": (ends - starts).tolist(), "n_known": known.tolist(), "base": base.tolist()})
            yield pa.RecordBatch.from_pylist(rows, pa.schema(_POST))

    # A slice's answers are as large as its words.
    answers = words.filter("slice is not null").groupBy("slice").agg(F.collect_list(F.struct("bucket", "counts", "places")).alias("answers"))
    return parts.select("slice", "ids", "held_out", "teaches", "tokens", "ends").join(answers, "slice").mapInArrow(run, _POST_SQL)


class _Bucket:
    """A bucket's tokens: distinct pairs (v, w) and triples (u, pair) with their counts."""

    def __init__(self, group: pa.Table):
        rows = [r for r in group.select(["slice", "docs", "v", "u", "w"]).to_pylist() if r["v"] is not None]
        docs = [unpack(r["docs"], np.uint32, True) for r in rows]
        self.slices = [(r["slice"], d >> 1) for r, d in zip(rows, docs)]
        whole = lambda k: np.concatenate([np.empty(0, np.uint32), *(unpack(r[k], np.uint32) for r in rows)]).astype(np.uint64)
        teaches = np.concatenate([np.empty(0, np.uint32), *docs]) & 1 == 1
        pairs, of_pair = np.unique(whole("v") << np.uint64(32) | whole("w"), return_inverse=True)
        self.v, self.w = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(NONE)).astype(np.int64)
        self.pairs, self.c2 = pairs, np.bincount(of_pair[teaches], minlength=len(pairs))
        triples, self.of_triple = np.unique(of_pair.astype(np.uint64) << np.uint64(32) | whole("u"), return_inverse=True)
        self.pair, self.u = (triples >> np.uint64(32)).astype(np.int64), (triples & np.uint64(NONE)).astype(np.int64)
        self.c3 = np.bincount(self.of_triple[teaches], minlength=len(triples))
        self.first = self.u == NONE

    def asked(self, model: Words) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """The pairs of split words, by the bucket that adds them up, and the cuts between these."""
        at = np.flatnonzero(model.hot(self.v))
        order, cut = cuts(bucket_of(self.pairs[at], model.buckets), model.buckets)
        return at[order], cut


def counted(c: np.ndarray, cutoff: int) -> list[int]:
    """How many of c are 0, 1, .. cutoff + 1."""
    return np.bincount(np.minimum(c, cutoff + 2), minlength=cutoff + 3)[: cutoff + 2].tolist()


def counts_of_counts(posts: DataFrame, model: Words, cutoff: int) -> DataFrame:
    """From each bucket: a row (bucket, n2, n3), how many whole pairs and triples have each count up to cutoff + 1, and a
    row (bucket, to, keys, parts) of its parts of the counts of split words' pairs for each bucket that adds them up."""

    def run(group: pa.Table) -> pa.Table:
        b, bucket = _Bucket(group), group.column("bucket")[0].as_py()
        order, cut = b.asked(model)
        rows = [{"bucket": bucket, "n2": counted(b.c2[~model.hot(b.v)], cutoff), "n3": counted(b.c3[~b.first], cutoff)}]
        rows += [{"bucket": bucket, "to": to, "keys": pack(b.pairs[order[s:e]], True), "parts": pack(b.c2[order[s:e]].astype(np.uint32))} for to, s, e in cut]
        return pa.Table.from_pylist(rows, pa.schema([("bucket", pa.int64()), ("n2", pa.list_(pa.int64())), ("n3", pa.list_(pa.int64())), ("to", pa.int64()), ("keys", pa.binary()), ("parts", pa.binary())]))

    return posts.groupBy("bucket").applyInArrow(run, "bucket long, n2 array<long>, n3 array<long>, to long, keys binary, parts binary")


def pair_totals(parts: DataFrame, model: Words, cutoff: int) -> DataFrame:
    """The answers (bucket, to, totals), the pairs in the order in which they were asked for; and of each split word v the
    rows (v, prior, total, n2): sums over its pairs here of P(w) and counts, and how many have each count."""

    def run(group: pa.Table) -> pa.Table:
        keys = [unpack(x, np.uint64, True) for x in group.column("keys").to_pylist()]
        n = [unpack(x, np.uint32) for x in group.column("parts").to_pylist()]
        found, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, np.concatenate(n).astype(float), len(found)).astype(np.int64)
        ends = np.cumsum([0, *map(len, keys)])
        rows = [{"bucket": b, "to": group.column("to")[0].as_py(), "totals": pack(total[at[s:e]].astype(np.uint64))} for b, s, e in zip(group.column("bucket").to_pylist(), ends, ends[1:])]
        found, total = found[total > 0], total[total > 0]
        words, of_word = np.unique((found >> np.uint64(32)).astype(np.int64), return_inverse=True)
        prior = np.bincount(of_word, model.prior[model.level((found & np.uint64(NONE)).astype(np.int64))], len(words))
        many = np.bincount(of_word * (cutoff + 3) + np.minimum(total, cutoff + 2), minlength=len(words) * (cutoff + 3)).reshape(-1, cutoff + 3)[:, : cutoff + 2]
        sums = np.bincount(of_word, total.astype(float), len(words))
        rows += [{"v": v, "prior": p, "total": int(t), "n2": m} for v, p, t, m in zip(words.tolist(), prior.tolist(), sums.tolist(), many.tolist())]
        return pa.Table.from_pylist(rows, pa.schema([("bucket", pa.int64()), ("to", pa.int64()), ("totals", pa.binary()), ("v", pa.int64()), ("prior", pa.float64()), ("total", pa.int64()), ("n2", pa.list_(pa.int64()))]))

    return parts.groupBy("to").applyInArrow(run, "bucket long, to long, totals binary, v long, prior double, total long, n2 array<long>")


def evaluated(posts: DataFrame, answers: DataFrame, model: Words) -> DataFrame:
    """(slice, docs, score, ...): sums of log10 P(w | u v) over the tokens of each text in a bucket; the rows without
    tokens as they are. answers (bucket, to, totals): the counts of pairs of split words."""

    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        b = _Bucket(group)
        prior1 = model.prior[model.level(b.w)]
        hot = model.hot(b.v)
        if answers.num_rows:
            found = sorted(zip(answers.column("to").to_pylist(), answers.column("totals").to_pylist()))
            b.c2[b.asked(model)[0]] = np.concatenate([unpack(x, np.uint64) for _, x in found])
        words, of_word = np.unique(b.v, return_inverse=True)
        seen = b.c2 > 0
        kept, prior = (np.bincount(of_word[seen], x[seen], len(words)) for x in (discounted(b.c2, model.small[2]), prior1))
        if hot.any():
            at = np.flatnonzero(model.hot(words))
            kept[at], prior[at] = model.split_sums[:, np.searchsorted(model.split, words[at])]
        share, rest = leftover(model.counts[model.level(words)], kept, prior)
        p2 = np.where(seen, share[of_word] * discounted(b.c2, model.small[2]), rest[of_word] * prior1)
        _, of_history = np.unique(b.u.astype(np.uint64) << np.uint64(32) | b.v[b.pair].astype(np.uint64), return_inverse=True)
        seen = b.c3 > 0
        kept3 = discounted(b.c3, model.small[3])
        sums = [np.bincount(of_history[seen], x[seen]) for x in (b.c3, kept3, p2[b.pair])]
        sums = [np.append(x, np.zeros(of_history.max(initial=-1) + 1 - len(x))) for x in sums]
        share, rest = leftover(*sums)
        p3 = np.where(seen, share[of_history] * kept3, rest[of_history] * p2[b.pair])
        value = np.log10(np.where(b.first, p2[b.pair], p3))[b.of_triple]
        out, at = [], 0
        for one, docs in b.slices:
            own = np.unique(docs)
            out.append({"slice": one, "docs": pack(own, True), "score": pack(np.bincount(docs, value[at : at + len(docs)])[own])})
            at += len(docs)
        out += [r for r in group.drop_columns(["bucket", "v", "u", "w"]).to_pylist() if r["ids"] is not None]
        return pa.Table.from_pylist(out, pa.schema([_POST[1], _POST[2], ("score", pa.binary()), *_POST[6:]]))

    return posts.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(run, _POST_SQL.replace("bucket long, ", "").replace("v binary, u binary, w binary", "score binary"))


def added_up(sums: DataFrame, tokens: int) -> DataFrame:
    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        (meta,) = (r for r in rows if r["ids"] is not None)
        score = np.zeros(len(meta["ids"]))
        for r in rows:
            if r["ids"] is None:
                score[unpack(r["docs"], np.uint32, True)] += unpack(r["score"], float)
        columns = [meta["ids"], meta["held_out"], meta["n_tokens"], meta["n_known"], [tokens] * len(score), meta["base"], score]
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table([pa.array(x, k) for x, k in zip(columns, kinds)], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return sums.groupBy("slice").applyInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", cutoff: int = CUTOFF, slice_bytes: int = SLICE_BYTES, bucket_bytes: int = BUCKET_BYTES, least_buckets: int = LEAST_BUCKETS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of docs; held_out: a column."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.coalesce(~held_out, F.lit(False)).alias("teaches"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(least_buckets, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // bucket_bytes))
    parts = bucketed_table(read_slices(docs, buckets, slice_bytes), "katz-slices", "slice")
    words = staged(count_words(parts, buckets), "katz-words")
    model = numbered(words, buckets, cutoff)
    posts = bucketed_table(post_tokens(parts, words, model), "katz-posts", "bucket", buckets)
    found = staged(counts_of_counts(posts, model, cutoff), "katz-counts")
    pairs = staged(pair_totals(found.filter("to is not null").select("bucket", "to", "keys", "parts"), model, cutoff), "katz-pairs")
    whole = found.agg(*(F.sum(F.coalesce(F.col(x)[c], F.lit(0))) for x in ("n2", "n3") for c in range(cutoff + 2))).first()
    split = pairs.filter("v is not null").groupBy("v").agg(F.sum("prior"), F.sum("total"), *(F.sum(F.col("n2")[c]) for c in range(cutoff + 2))).collect()
    many = {n: np.array([x or 0 for x in whole[i * (cutoff + 2) : (i + 1) * (cutoff + 2)]]) for i, n in enumerate((2, 3))}
    rows = sorted(tuple(r) for r in split)
    of_split = np.array([r[3:] for r in rows], np.int64).reshape(-1, cutoff + 2)
    many[2] = many[2] + of_split.sum(axis=0)
    for n in (2, 3):
        model.small[n] = discounts(many[n].tolist(), cutoff)
    kept = np.array([r[2] for r in rows], float) - of_split[:, : cutoff + 1] @ (np.arange(cutoff + 1) - model.small[2])
    model.split, model.split_sums = np.array([r[0] for r in rows], np.int64), np.array([kept, [r[1] for r in rows]])
    return added_up(evaluated(posts, pairs.filter("to is not null").select("bucket", "to", "totals"), model), model.tokens)


def op3_katz(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, crc_bucket(F.col("doc_id"), 10) == 0)
