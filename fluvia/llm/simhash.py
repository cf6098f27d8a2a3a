"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing.

A fingerprint has 64 bits; two texts link if their fingerprints differ in at most RADIUS bits. For the
covering family every bit i gets a non-zero vector m(i) of RADIUS + 1 bits, and each non-zero vector v
gives one mask of the bits i with odd parity of m(i) & v. Any RADIUS differing bits leave some v that is
orthogonal to all of their vectors, so in v's table, keyed by fingerprint & mask, the pair collides: no
linked pair is lost. A table's bucket is reduced to a spanning forest of its true links (never all pairs),
the forests of all tables meet in connected components over distinct fingerprints.

Wide links are for a similarity of 0.8 or more: there fingerprints differ in about 10 bits. The bits are dealt
into WIDE_PARTS parts with a covering family each; fingerprints that differ in WIDE_PARTS * (RADIUS + 1) - 1
bits or fewer have a part with RADIUS or fewer, so they collide. Of what collides, pairs of WIDE_RADIUS bits
or fewer are compared by a second word of 64 one-bit min-hashes of the same shingles, which also tells short
texts apart; pairs are candidates if at most SKETCH_RADIUS of these differ. A bucket gives the spanning forest of its
candidates that takes the least differing ones first, so that texts which are truly similar hang together by
similar ones. first_rows() then compares the shingle sets of each link's two texts, and only pairs of a Jaccard
similarity of LEAST_SIMILARITY or more stay linked. A forest holds no second way between texts whose link is not
confirmed, and not all such pairs collide; so the prefixes of the shingle sets of different groups are joined (setjoin),
and what may be similar is compared in the same way. Two texts are linked exactly if their similarity is that.

Defined cases: a null text counts as empty; an empty text has fingerprint zero and links like any other;
repeated rows get one row each and the same result; a row whose id is null gets a fingerprint and the
component of its text's linked documents (null if no linked document has an id). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import setjoin
from .common import WORD, row_key, slices, staged

RADIUS, BITS, SEED, SHINGLE = 4, 64, 42, 4
WIDE_PARTS, WIDE_RADIUS, SKETCH_RADIUS = 2, 15, 13
LEAST_SIMILARITY = (4, 5)

_FACTORS, _ADDENDS = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BITS), np.uint64)
_FACTORS |= np.uint64(1)


def shingle_hashes(text: str | None, words: int = SHINGLE) -> np.ndarray:
    """The 64-bit hashes of a text's word shingles, repeats included; none without words."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    line = b" ".join(found)
    ends = list(accumulate(map(len, found), lambda a, n: a + n + 1))
    n = max(1, len(found) - words + 1)
    starts = [0, *(e + 1 for e in ends[: n - 1])]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[s:e], SEED) for s, e in zip(starts, ends[min(words, len(found)) - 1 :])), np.uint64, n)


def _word(bits: np.ndarray) -> int:
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def majority(h: np.ndarray) -> int:
    """Unsigned 64-bit SimHash of hashes: the bits set in over half of them; 0 of none."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 8192):
        ones += np.unpackbits(h[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return _word(2 * ones > len(h))


def minima(h: np.ndarray) -> int:
    """64 one-bit min-hashes of hashes; two sets of similarity j agree in a bit with probability (1 + j) / 2. 0 of none."""
    least = np.full(BITS, np.iinfo(np.uint64).max)
    for at in range(0, len(h), 1024):
        np.minimum(least, (h[at : at + 1024, None] * _FACTORS + _ADDENDS).min(axis=0), out=least)
    return _word((least >> np.uint64(30)) & np.uint64(1) == 1) if len(h) else 0


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash over word shingles, repeats included; 0 without words."""
    return majority(shingle_hashes(text, words))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE, wide: bool = False) -> DataFrame:
    """(doc_id, fp), with wide (doc_id, fp, sketch): the fingerprint and the one-bit min-hashes as signed longs."""
    parts = [majority, minima] if wide else [majority]
    names = ["fp", "sketch"][: len(parts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = np.array([[f(h) for f in parts] for h in (shingle_hashes(x, words) for x in part.column(1).to_pylist())], np.uint64)
            found = found.reshape(-1, len(parts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(found[:, i]) for i in range(len(parts)))], ["doc_id", *names])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, ", ".join(f"{x} long" for x in ("doc_id", *names)))


def covering_masks(radius: int = RADIUS, bits: int = BITS, parts: int = 1) -> list[int]:
    """2**(radius + 1) - 1 masks of each part of the bits.

    Each pair within the radius in some part, so each that differs in parts * (radius + 1) - 1 bits or fewer, agrees on
    all bits of some mask.
    """
    top, size = (1 << (radius + 1)) - 1, bits // parts
    vectors = [1 + i % top for i in range(size)]
    masks = [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, top + 1)]
    return [m << size * j for j in range(parts) for m in masks]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(fps: np.ndarray, ids: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that join the same ids as all pairs of fps within the radius do, at most len(ids) - 1 of them."""
    links, rest = [], np.arange(1, len(fps))
    todo = [0]
    while len(rest):
        if not todo:
            todo, rest = [int(rest[0])], rest[1:]
            continue
        at = todo.pop()
        near = np.bitwise_count(fps[rest] ^ fps[at]) <= radius
        if near.any():
            new = rest[near]
            links += [(int(ids[at]), int(ids[x])) for x in new]
            todo += new.tolist()
            rest = rest[~near]
    return links


def nearest_forest(fps: np.ndarray, ids: np.ndarray, sketches: np.ndarray, radius: int = WIDE_RADIUS) -> list[tuple[int, int]]:
    """The same for pairs within the radius and SKETCH_RADIUS, by the links of the fewest differing bits."""
    links, far = [], np.uint16(1 << 15)
    rest = np.arange(1, len(fps))  # not in the forest yet, with the least bits to it and the row these are to
    bits, to, at = np.full(len(rest), far), np.zeros(len(rest), np.int64), 0
    while len(rest):
        a, b = np.bitwise_count(fps[rest] ^ fps[at]), np.bitwise_count(sketches[rest] ^ sketches[at])
        new = np.where((a <= radius) & (b <= SKETCH_RADIUS), a + np.uint16(2) * b, far)
        less = new < bits
        bits[less], to[less] = new[less], at
        i = int(bits.argmin())
        at = int(rest[i])
        if bits[i] < far:
            links.append((int(ids[to[i]]), int(ids[at])))
        for x in (rest, bits, to):
            x[i] = x[-1]
        rest, bits, to = rest[:-1], bits[:-1], to[:-1]
    return links


def linked_rows(ends: np.ndarray, fps: np.ndarray, radius: int, sketches: np.ndarray | None = None) -> np.ndarray:
    """Whether each row has a link in its bucket; rows of a bucket are neighbours, ends is the end of each row's bucket."""
    found = np.zeros(len(fps), bool)
    rows, step = np.flatnonzero(ends > np.arange(len(fps)) + 1), 1
    while len(rows):
        near = rows[np.bitwise_count(fps[rows] ^ fps[rows + step]) <= radius]
        if sketches is not None:
            near = near[np.bitwise_count(sketches[near] ^ sketches[near + step]) <= SKETCH_RADIUS]
        found[near] = found[near + step] = True
        step += 1
        rows = rows[ends[rows] > rows + step]
    return found


_ROW = ("t", "k", "fp", "id", "m", "s")
#: Up to this size a bucket's rows are all compared, by vector operations over many buckets; the links found do not depend on it.
SMALL = 1024


def _bucket_links(radius: int, limit: int | None, wide: bool):
    """For mapInArrow over rows (table, key, fp, id, mask[, sketch]) sorted by (table, key): rows (a, b, and these).

    A bucket's links come as a, b. The rows of a bucket over the limit come back as they are, for finer keys, but where
    the mask leaves so few bits that all of them are linked; without a limit, none does.
    """
    names = _ROW if wide else _ROW[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def done(columns: list[np.ndarray], last: bool):
            t, k, fp, ident, mask = columns[:5]
            sketch = columns[5] if wide else None
            new = np.flatnonzero((t[1:] != t[:-1]) | (k[1:] != k[:-1])) + 1
            bounds = np.concatenate([[0], new, [len(t)]]) if len(t) else np.zeros(1, np.int64)
            stop = max(len(bounds) - 1 if last else len(bounds) - 2, 0)
            sizes, starts = np.diff(bounds)[:stop], bounds[:stop]
            large = (sizes > limit) & (BITS - np.bitwise_count(mask[starts]) > radius) if limit else np.zeros(stop, bool)
            r = np.flatnonzero(np.repeat(large, sizes))
            # Rows of small buckets without a link there are told first, for all buckets at once.
            small = sizes <= SMALL
            ends = np.repeat(np.where(small & ~large, starts + sizes, 0), sizes)
            hit = linked_rows(ends, fp[: len(ends)], radius, sketch) | np.repeat(~small & ~large, sizes)
            hit = np.flatnonzero(hit)
            bucket = np.repeat(np.arange(stop), sizes)[hit]
            links = []
            for rows in np.split(hit, np.flatnonzero(np.diff(bucket)) + 1):
                links += nearest_forest(fp[rows], ident[rows], sketch[rows], radius) if wide else forest(fp[rows], ident[rows], radius)
            a = np.array(links, np.int64).reshape(-1, 2)
            nulls = lambda n: pa.nulls(n, pa.int64())
            out = pa.RecordBatch.from_arrays(
                [pa.concat_arrays(x) for x in ([pa.array(a[:, 0]), nulls(len(r))], [pa.array(a[:, 1]), nulls(len(r))], *([nulls(len(a)), pa.array(c[r].view(np.int64))] for c in columns))],
                ["a", "b", *names],
            )
            return out, [c[bounds[stop] :] for c in columns]

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [np.asarray(c) for c in batch.columns]
            for i in (2, 4, 5)[: len(columns) - 3]:
                columns[i] = columns[i].view(np.uint64)
            held.append(columns)
            if all(held[0][i][0] == columns[i][-1] for i in (0, 1)):
                continue  # one bucket so far
            out, rest = done([np.concatenate(x) for x in zip(*held)], False)
            held = [rest]
            if out.num_rows:
                yield out
        if held:
            out, _ = done([np.concatenate(x) for x in zip(*held)], True)
            if out.num_rows:
                yield out

    return run


def links(distinct: DataFrame, radius: int = RADIUS, max_bucket: int = 20_000, wide: bool = False) -> DataFrame:
    """(a, b): a spanning set of the links between rows (fp, id), with wide (fp, id, s), of distinct fingerprints.

    A bucket over max_bucket is keyed anew, by finer masks: of radius + 1 blocks of the bits outside its mask, a linked
    pair agrees in one at least, so nothing is lost (wide: no pair that the covering is sure to find). That goes on while
    buckets are over it and bits are left: a bucket of distinct fingerprints that agree in all but n bits has 2**n rows
    at most. Wide links take more blocks and have more bits left, so they are keyed anew once: what is still over the limit
    are mostly near copies of each other, and a forest takes all rows near its first one out at once.
    """
    masks = covering_masks(RADIUS, parts=WIDE_PARTS) if wide else covering_masks(radius)
    sure = WIDE_PARTS * (RADIUS + 1) - 1 if wide else radius
    names, more = (_ROW, ["s"]) if wide else (_ROW[:-1], [])
    rows = distinct.select("fp", "id", *more, F.posexplode(F.array(*(F.lit(_signed(m)) for m in masks))).alias("t", "m"))
    out, again = None, True
    while True:
        keyed = rows.select(F.col("t").cast("long").alias("t"), F.col("fp").bitwiseAND(F.col("m")).alias("k"), "fp", "id", "m", *more)
        keyed = keyed.repartition("t", "k").sortWithinPartitions("t", "k")
        schema = ", ".join(f"{x} long" for x in ("a", "b", *names))
        found = staged(keyed.select(*names).mapInArrow(_bucket_links(WIDE_RADIUS if wide else radius, max_bucket if again else None, wide), schema), "simhash-links")
        links = found.filter("a is not null").select("a", "b")
        out = links if out is None else out.unionByName(links)
        large = found.filter("a is null")
        if not again or large.isEmpty():
            break
        again = not wide
        # The blocks of the free bits, dealt in turn; a mask takes one more block than the one before.
        free = F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.getbit("m", i) == 0)
        block = lambda j: F.aggregate(F.filter(free, lambda i, at: at % (sure + 1) == j), F.col("m"), lambda m, i: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
        rows = large.select("fp", "id", *more, "t", F.posexplode(F.array(*(block(j) for j in range(sure + 1)))).alias("j", "m"))
        rows = rows.select("fp", "id", *more, (F.col("t") * (sure + 1) + F.col("j")).alias("t"), "m")
    return out.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of undirected edges (a, b): component is the smallest node reached.

    Alternates large-star and small-star steps, each a grouped minimum joined back to the edges; the lineage
    is cut after each round, and rounds stop when no edge changes.
    """
    edges = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "components")
    size = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = staged(small, "components")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == size:
            break
        size = now
    else:
        raise RuntimeError("components did not settle")
    return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, max_bucket: int = 20_000, words: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) of every row of docs."""
    fps = staged(fingerprints(docs, id_col, text_col, words), "simhash")
    distinct = fps.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("id"))
    # Each document of a fingerprint is linked to all others of it; its smallest id stands for it.
    found = components(links(distinct, radius, max_bucket))
    named = distinct.join(found, distinct.id == found.node, "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    # A table of its own, so that the join can split the partition of a very common fingerprint.
    return fps.join(staged(named, "simhash-named"), "fp", "left").select("doc_id", "fp", "component_id")


def frequent_shingles(texts: DataFrame, words: int, n_texts: int, sample: int = 10_000, share: int = 5, least: int = 4, most: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ranks), sorted by hash: shingles in `least` or more of some of the texts (node, text), the rarest of them first.

    Some are one text in `share`, or `sample` if these are more, so that what is frequent does not depend on how many there
    are. They only say which shingles the set join puts last, so that its groups are small; its pairs do not depend on them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [np.unique(shingle_hashes(x, words)) for x in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["h"])

    picked = texts.filter(F.pmod("node", F.lit(min(share, max(1, n_texts // sample)))) == 0).dropDuplicates(["node"])
    counts = picked.select("node", "text").mapInArrow(run, "h long").groupBy("h").count().filter(F.col("count") >= least)
    found = counts.orderBy(F.desc("count"), "h").limit(most).toArrow()
    h, n = np.asarray(found.column("h")).view(np.uint64), np.asarray(found.column("count"))
    by = np.argsort(h)
    ranks = np.empty(len(h), np.int64)
    ranks[np.lexsort((h, n))] = np.arange(len(h))
    return h[by], ranks[by]


def described(texts: DataFrame, words: int, least: tuple[int, int], frequent: np.ndarray, ranks: np.ndarray) -> DataFrame:
    """(node, fp, s, n, prefix, parity) of texts (node, text): fingerprint, one-bit min-hashes, and of the set of shingles
    its size, prefix and parities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hashes = [shingle_hashes(x, words) for x in part.column(1).to_pylist()]
            sets = [np.unique(h) for h in hashes]
            firsts = [setjoin.prefix(h, frequent, ranks, least) for h in sets]
            bounds = pa.array(np.cumsum([0, *map(len, firsts)]), pa.int32())
            words_of = [pa.array(np.array([f(h) for h in hashes], np.uint64).view(np.int64)) for f in (majority, minima)]
            prefixes = pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(firsts).view(np.int64)))
            rest = [pa.array([len(h) for h in sets], pa.int64()), prefixes, pa.array([setjoin.parities(h) for h in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([part.column(0), *words_of, *rest], ["node", "fp", "s", "n", "prefix", "parity"])

    return texts.select("node", "text").mapInArrow(run, "node long, fp long, s long, n long, prefix array<long>, parity array<long>")


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """(node, h) of texts (node, text): the different hashes of the shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [np.unique(shingle_hashes(x, words)).view(np.int64) for x in part.column(1).to_pylist()]
            bounds = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(found)))], ["node", "h"])

    return texts.select("node", "text").mapInArrow(run, "node long, h array<long>")


def confirmed(links: DataFrame, texts: Callable[[DataFrame], DataFrame], words: int, least: tuple[int, int] = LEAST_SIMILARITY) -> DataFrame:
    """The links (a, b) whose texts' sets of word shingles have a Jaccard similarity of `least`; texts gives the (node, text) of nodes."""
    links = staged(links, "simhash-candidates")
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = staged(shingle_sets(texts(nodes), words), "simhash-sets")
    one, two = (sets.select(F.col("node").alias(x), F.col("h").alias(f"h{x}")) for x in "ab")
    both = F.size(F.array_intersect("ha", "hb"))
    pairs = links.join(one, "a").join(two, "b").withColumn("both", both)
    near = pairs.filter(least[1] * F.col("both") >= least[0] * (F.size("ha") + F.size("hb") - F.col("both"))).select("a", "b")
    return staged(near, "simhash-confirmed")


def first_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bucket: int = 20_000, words: int = 5) -> DataFrame:
    """(key): the row_key() of the row to keep of each group of texts with links, the first by id, then by key.

    Texts link if their sets of shingles have a Jaccard similarity of LEAST_SIMILARITY, and no such link is lost: the
    fingerprints find most groups, the set join the links between what is not one group yet. Groups are of texts, so that
    rows of one id whose texts do not link stay in groups of their own; texts without words are one text. Rows whose id
    is null are in no group.
    """
    ident, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    rows = docs.filter(ident.isNotNull()).select(row_key(ident, text).alias("key"), ident.alias("ident"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.withColumn("node", F.xxhash64(F.when(F.col("text").rlike(WORD), F.col("text")).otherwise("")))
    # Of a large group of one text a single row goes on.
    first = staged(rows.groupBy("node").agg(F.min(F.struct("ident", "key")).alias("first")), "simhash-nodes")

    def texts(nodes: DataFrame) -> DataFrame:
        keys = nodes.select(F.col("first.key").alias("key"))
        return rows.join(keys, "key", "left_semi").dropDuplicates(["key"])

    sets = staged(described(texts(first), words, LEAST_SIMILARITY, *frequent_shingles(rows, words, first.count())), "simhash")
    of = lambda nodes: texts(first.join(nodes, "node", "left_semi"))
    fps = sets.select("node", "fp", "s")
    # A text of each fingerprint is compared with the others of it, and stands for them in the buckets.
    distinct = staged(fps.groupBy("fp").agg(F.min(F.struct("node", "s")).alias("x")).select("fp", F.col("x.node").alias("id"), F.col("x.s").alias("s")), "simhash-distinct")
    same = fps.join(distinct.select("fp", "id"), "fp").filter("node <> id").select(F.least("id", "node").alias("a"), F.greatest("id", "node").alias("b"))
    found = components(confirmed(links(distinct, max_bucket=max_bucket, wide=True).unionByName(same), of, words))
    found = staged(found, "simhash-found")
    grouped = sets.join(found, "node", "left").select("node", "n", "prefix", F.coalesce("component", "node").alias("c"))
    met = setjoin.meeting(grouped, LEAST_SIMILARITY, hashes=lambda nodes: shingle_sets(of(nodes), words))
    more = confirmed(setjoin.maybe_similar(met, sets, LEAST_SIMILARITY), of, words)
    found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    least = first.join(found, "node", "left").groupBy(F.coalesce("component", "node").alias("group")).agg(F.min("first").alias("first"))
    return least.select(F.col("first.key").alias("key"))


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    from .common import read_table

    out = near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
