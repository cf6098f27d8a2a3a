"""Ids, texts and offsets of the Arrow-batched tokenizers library against tiktoken and the library's own offsets."""

import hashlib
import os

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from test_bpe import texts_of
from tokenizers import Regex, Tokenizer, pre_tokenizers

from fluvia.llm import bytetokens

SF_DIR = "/root/testdata/sf0.001"


def other(name=bytetokens.FILE):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytetokens.read_ranks(public_tokenizers.path(name)), special_tokens={})


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_ids_and_bytes(spark, name):
    texts = [*texts_of(200), None, "", "<|endoftext|>", "ab" * 5000, "=" * 3000, " " * 2000 + "x", "👩‍👩‍👧日本\u0085 x"]
    docs = spark.createDataFrame([(i % 150, t, b"x") for i, t in enumerate(texts)] + [(0, texts[0], b"x"), (None, "a", b"y")], "doc_id long, text string, ids binary")
    found = bytetokens.encode(docs, path=public_tokenizers.path(name), decode=True).collect()
    told = sorted((-1 if r.doc_id is None else r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in found)
    library = other(name)
    expected = [(i % 150, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in enumerate(texts)]
    assert told == sorted([*expected, (0, *expected[0][1:]), (-1, tuple(library.encode_ordinary("a")), b"a")])
    assert bytetokens.encode(docs.limit(0)).count() == 0


def test_offsets(spark):
    texts = [*texts_of(120, 8), "", "日本語 é 😀", "ሴ" * 20]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in bytetokens.encode(docs, offsets=True).collect()}
    ranks = bytetokens.read_ranks(public_tokenizers.path(bytetokens.FILE))
    library = Tokenizer.from_str(bytetokens.library_form(ranks))
    split = pre_tokenizers.Split(Regex(public_tokenizers.PATTERN), "isolated")
    library.pre_tokenizer = pre_tokenizers.Sequence([split, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    tokens = {r: t for t, r in ranks.items()}
    for i, t in enumerate(texts):
        r, whole = found[i], t.encode()
        told = library.encode(t, add_special_tokens=False)
        assert r.ids == told.ids
        assert list(zip(r.char_starts, r.char_ends)) == told.offsets
        starts = [0, *r.byte_ends[:-1]] if r.ids else []
        assert [whole[s:e] for s, e in zip(starts, r.byte_ends)] == [tokens[x] for x in r.ids]
        assert r.n_split == sum(e < len(whole) and whole[e] & 0xC0 == 0x80 for e in r.byte_ends)


def test_split_characters(spark):
    table = bytetokens.ByteTable(bytetokens.read_ranks(public_tokenizers.path(bytetokens.FILE)))
    text = "日本語 😀 é"
    ids = other().encode_ordinary(text)
    stream = bytetokens.TextStream(table)
    parts = [stream.feed([x]) for x in ids] + [stream.feed([], last=True)]
    assert "".join(parts) == text and "" in parts[:-1]
    broken = bytetokens.TextStream(table)
    assert broken.feed(ids[:1]) + broken.feed([], last=True) == "�"
    rows = spark.createDataFrame([(1, ids), (2, []), (3, None)], "k int, ids array<int>")
    assert [r.decoded if r.decoded is None else bytes(r.decoded) for r in bytetokens.decode(rows).orderBy("k").collect()] == [text.encode(), b"", None]


def test_every_code_point_splits_alike():
    library, spec = other(), bytetokens.library_form(bytetokens.read_ranks(public_tokenizers.path(bytetokens.FILE)))
    encoder = bytetokens.Encoder(spec, public_tokenizers.PATTERN)
    texts = ["".join(chr(c) + " a" for c in range(s, s + 512) if not 0xD800 <= c < 0xE000) for s in range(0, 0x110000, 512)]
    assert [np.frombuffer(x, np.int32).tolist() for x in encoder.encode_many(texts)] == library.encode_ordinary_batch(texts)


def test_refused():
    with pytest.raises(ValueError):
        bytetokens.library_form({b"a": 0})
    with pytest.raises(ValueError):
        bytetokens.Encoder(bytetokens.library_form({bytes([b]): b for b in range(256)}), "(a)|b")
    assert regex.compile(public_tokenizers.PATTERN).groups == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables here")
def test_query(spark):
    library = other()
    found = {r.doc_id: r for r in bytetokens.op11_bytes(spark, SF_DIR).collect()}
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text or "")
        own = found[r.doc_id]
        assert own.n_tokens == len(ids)
        assert own.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert own.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
