"""Byte-level BPE by the tokenizers library over Arrow batches, from a rank file, with offsets in bytes and characters.

A rank file lists tokens as bytes with their ranks. The library wants letters and merge rules: each byte is written as a
printable letter, and the rule of a token is the pair into which the tokens of lower rank merge it. A token that they do
not merge into a pair has no rule; it comes up only where a whole piece equals it. The pieces are the matches of `pattern`;
the library gets the different ones of a slice of a batch, and pieces that came up lately keep their ids.

Offsets come from the bytes: a token's end is the sum of the sizes so far, and a table from each byte to its character
(bytes that continue a character count for the one they belong to) turns it into characters. Where a token begins or ends
within a character, its character range takes in the whole of it. Decoding puts the tokens' bytes one after the other,
so text that was split within a character is whole again; TextStream holds an unfinished character back until the rest
has come.

Defined cases: a null text is empty and has no tokens; repeated rows get one row each; extra columns are ignored; ids are
ranks; texts of any length are whole (a piece is merged by a heap, not in quadratic time); there are no special tokens,
strings that look like one are ordinary text. A file without all 256 single bytes is refused, and so is a pattern with
groups, or one that leaves out a part of a text.
"""

from __future__ import annotations

import base64
import codecs
import functools
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from .bpe import byte_letters
from .common import joined_bytes, read_table, slices

FILE, KNOWN, SLICE = "byte_bpe_50k.tiktoken", 1 << 18, 4 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def last_pair(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that the tokens of lower rank merge a token into; None if they leave more."""
    parts, own = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], own), i) for i in range(len(parts) - 1))
        if rank >= own:
            return None
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def library_form(ranks: dict[bytes, int]) -> str:
    """The tokenizer of a rank file, for single pieces, as the library's JSON."""
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the rank file lacks single bytes")
    letter = {b: c for c, b in byte_letters().items()}
    spell = lambda token: "".join(map(letter.__getitem__, token))
    ordered = sorted(ranks, key=ranks.__getitem__)
    pairs = (last_pair(t, ranks) for t in ordered if len(t) > 1)
    merges = [(spell(p[0]), spell(p[1])) for p in pairs if p]
    out = Tokenizer(models.BPE({spell(t): r for t, r in ranks.items()}, merges, ignore_merges=True))
    out.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return out.to_str()


class ByteTable:
    """The bytes of each id, and what follows from them: decoded bytes, offsets in bytes and in characters."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = {r: t for t, r in ranks.items()}
        ordered = [tokens.get(i, b"") for i in range(max(tokens, default=-1) + 1)]
        self.data = np.frombuffer(b"".join(ordered), np.uint8)
        self.size = np.fromiter(map(len, ordered), np.int64, len(ordered))
        self.at = np.cumsum(self.size) - self.size

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """The byte at which each token ends, over all ids given."""
        return np.cumsum(self.size[ids])

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The tokens' bytes, one after the other."""
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.at[ids] - (ends - size), size)]


def inner(data: np.ndarray) -> np.ndarray:
    """Whether each byte of UTF-8 continues a character."""
    return (data & 0xC0) == 0x80


def characters(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The characters that byte ranges within a valid UTF-8 text touch, as [start, end) in characters."""
    number = np.append(np.cumsum(~inner(data)), 0)  # of a byte's character, from 1
    return number[starts] - 1, np.where(ends > starts, number[ends - 1], number[starts] - 1)


class TextStream:
    """Text of ids that come in parts: an unfinished character at the end of a part waits for the next one."""

    def __init__(self, table: ByteTable):
        self.table, self.state = table, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int], last: bool = False) -> str:
        return self.state.decode(self.table.decode(np.fromiter(ids, np.int64)).tobytes(), last)


class Encoder:
    """The library's tokenizer, and the ids of the pieces met lately."""

    def __init__(self, spec: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.library, self.pieces = Tokenizer.from_str(spec), regex.compile(pattern)
        if self.pieces.groups:
            raise ValueError("the pattern has groups")
        self.known: dict[str, bytes] = {}

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit integers."""
        parts = [self.pieces.findall(x) for x in texts]
        now = set().union(*parts)
        if len(self.known) > KNOWN:
            self.known = {w: x for w, x in self.known.items() if w in now}
        new = [w for w in now if w not in self.known]
        found = self.library.encode_batch_fast(new, add_special_tokens=False)
        self.known.update((w, np.array(x.ids, np.int32).tobytes()) for w, x in zip(new, found))
        return [b"".join(map(self.known.__getitem__, x)) for x in parts]


@functools.lru_cache(maxsize=2)
def _encoder(spec: str, pattern: str) -> Encoder:
    return Encoder(spec, pattern)


def _default() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(FILE), public_tokenizers.PATTERN


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False, decode: bool = False) -> DataFrame:
    """(doc_id, ids, n_split): the ids, and how many tokens end within a character.

    offsets adds the arrays byte_ends, char_starts and char_ends, one entry a token; decode adds `decoded`, the bytes of
    the ids. The rank file is read by the driver; what is made of it (of a vocabulary's size) is broadcast.
    """
    ranks = read_ranks(path or _default()[0])
    shared = docs.sparkSession.sparkContext.broadcast((library_form(ranks), pattern or _default()[1], ByteTable(ranks)))
    more = ["byte_ends array<int>", "char_starts array<int>", "char_ends array<int>"] * offsets + ["decoded binary"] * decode
    schema = ", ".join(["doc_id long", "ids array<int>", "n_split int", *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec, pattern, table = shared.value
        encoder = _encoder(spec, pattern)
        for part in slices(batches, max_bytes=SLICE):
            ids = encoder.encode_many([x or "" for x in part.column(1).to_pylist()])
            count = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            flat = np.frombuffer(b"".join(ids), np.int32).astype(np.int64)
            bounds = np.append(0, np.cumsum(count))
            data, at = joined_bytes(part.column(1))
            ends = table.ends(flat)
            if not np.array_equal(np.append(0, ends)[bounds], at):
                raise ValueError("the ids do not cover the texts")
            cut = inner(np.append(data, np.uint8(0)))[ends]
            n_split = np.diff(np.append(0, np.cumsum(cut))[bounds])
            lists = lambda values: pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))
            columns = [part.column(0), lists(flat), pa.array(n_split, pa.int32())]
            if offsets:
                first, last = characters(data, ends - table.size[flat], ends)
                base = np.repeat(np.append(0, np.cumsum(~inner(data)))[at[:-1]], count)
                columns += [lists(ends - np.repeat(at[:-1], count)), lists(first - base), lists(last - base)]
            if decode:
                out = table.decode(flat).tobytes()
                columns.append(pa.array([out[s:e] for s, e in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, path: str | None = None, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """rows with a binary column `out`, the bytes of the ids in an array column; null ids give null."""
    shared = rows.sparkSession.sparkContext.broadcast(ByteTable(read_ranks(path or _default()[0])))

    @F.pandas_udf("binary")
    def joined(ids):
        return ids.map(lambda x: None if x is None else shared.value.decode(np.asarray(x, np.int64)).tobytes())

    return rows.withColumn(out, joined(F.col(ids_col)))


def op11_bytes(spark, sf_dir: str) -> DataFrame:
    out = encode(read_table(spark, sf_dir, "documents"), decode=True)
    joined = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), F.col("n_split").cast("long").alias("n_split"))
