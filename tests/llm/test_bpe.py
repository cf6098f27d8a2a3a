"""Ids and texts against the tokenizers library."""

import random
from array import array

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fluvia.llm import bpe, editcount

SPECIAL = "<|endoftext|>"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def texts_of(n, seed=2):
    rng = random.Random(seed)
    parts = ["the", "ing", " of", "'ll", "'s", "  ", "\n\n", "\t", "é", "日本語", "😀", "123", "a" * 40, "!!!", " ", "\x1c", " ", "x́", SPECIAL, "<|end", "zq", "Hello", "0.5", "ſ", "\x00"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(n)]


def test_ids_and_texts(spark, library):
    texts = [*texts_of(300), None, "", SPECIAL, "ab" * 5000, "=" * 3000]
    docs = spark.createDataFrame([(i, t, b"x") for i, t in enumerate(texts)], "doc_id long, text string, ids binary")
    found = {r.doc_id: r for r in bpe.encode(docs, decode=True).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(found[i].ids, "<u4").tolist() == ids, i
        assert found[i].decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(docs.limit(0)).count() == 0
    assert bpe.encode(spark.createDataFrame([(None, "a"), (None, "a")], "doc_id long, text string")).count() == 2


def test_counts_after_edits(spark, library):
    rng = random.Random(9)
    texts = [t.replace(SPECIAL, "") for t in texts_of(60, 4)] + ["word " * 3000, None, ""]
    rows, after = [], []
    for i, t in enumerate(texts):
        edits, now = [], t or ""
        for _ in range(rng.randint(0, 6)):
            at, drop, put = rng.randint(-2, len(now) + 3), rng.randint(0, 9), rng.choice(["", " ", "x", " the end", "\n\n", "'ll", "  a"])
            edits.append((at, drop, put))
            at = min(max(at, 0), len(now))
            now = now[:at] + put + now[min(at + drop, len(now)) :]
        rows.append((i, t, edits))
        after.append(now)
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<at:int,drop:int,put:string>>")
    states = editcount.keep(docs).join(docs.select("doc_id", "edits"), "doc_id")
    found = {r.doc_id: r for r in editcount.edit(states).collect()}
    library.encode_special_tokens = True
    for i, (t, now) in enumerate(zip(texts, after)):
        count = lambda x: len(library.encode(x, add_special_tokens=False).ids)
        assert (found[i].text, found[i].n_before, found[i].n_after) == (now, count(t or ""), count(now)), i
    library.encode_special_tokens = False
    assert found[60].n_encoded < 100 < found[60].n_pretokens
    assert editcount.edit(states.limit(0)).count() == 0


def test_states_take_edits_again_without_encoding_the_rest(spark, library):
    text = "".join(f"word{i} of {i * 7919 % 1000}\n" for i in range(4000))
    states = editcount.keep(spark.createDataFrame([(1, text), (2, "kept as it is"), (None, None)], "doc_id long, text string"))
    kept = {r.doc_id: r for r in states.collect()}
    library.encode_special_tokens = True
    for round, (at, drop, put) in enumerate([(20000, 3, " one"), (20010, 0, "'ll"), (5, 900, "")]):
        edits = spark.createDataFrame([(1, 0, at, drop, put)], "doc_id long, seq int, at int, drop int, put string")
        states = editcount.edit(editcount.with_edits(states, edits)).select("doc_id", "text", "lengths", "counts", "n_before", "n_after", "n_pretokens", "n_encoded")
        rows = {r.doc_id: r for r in states.collect()}
        text = text[:at] + put + text[at + drop :]
        r = rows[1]
        words = [w for w, _ in library.pre_tokenizer.pre_tokenize_str(text)]
        assert (r.text, r.n_after, r.n_pretokens) == (text, len(library.encode(text, add_special_tokens=False).ids), len(words))
        assert np.frombuffer(r.lengths, "<u4").sum() == len(text) and np.frombuffer(r.counts, "<u4").sum() == r.n_after
        assert 0 < r.n_encoded < 20, round
        assert (rows[2].text, rows[2].counts, rows[2].n_encoded) == (kept[2].text, kept[2].counts, 0)
        assert (rows[None].text, rows[None].n_after) == ("", 0)
        states = spark.createDataFrame(states.collect(), states.schema).select("doc_id", "text", "lengths", "counts")
    library.encode_special_tokens = False


def test_long_words_and_slices_agree(library):
    """Words read side by side, by the plain loop, and by the library are the same."""
    codec = bpe._codec(open(bpe.default_path(), "rb").read())
    rng = random.Random(3)
    words = ["".join(rng.choices("abeinorst'", k=rng.randint(1, 90))) for _ in range(400)] + ["aaaa" * n for n in range(1, 20)] + [""]
    raw = [w.encode() for w in words]
    for w, side_by_side in zip(words, codec.automaton.encode_words(raw)):
        assert side_by_side == codec.automaton.encode_long(w.encode())
        if "'" not in w:
            assert np.frombuffer(side_by_side, "<u4").tolist() == library.encode(w, add_special_tokens=False).ids
    assert codec.automaton.encode_words([]) == []


def test_a_worker_keeps_small_tables():
    """Each Python worker has a codec of its own: a dense table of nodes and bytes alone took 67 MB."""
    automaton = bpe.Codec(open(bpe.default_path(), "rb").read()).automaton
    assert 1e6 < sum(memoryview(x).nbytes for x in vars(automaton).values() if isinstance(x, (np.ndarray, array))) < 1e7


def test_patterns_agree():
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choices("ab é'srtvel1\u0663 \n\t .!_\u00a0\u0345\uff41\u4e2d\u00bd\x1c\U0001f600\U00010330", k=12))
        assert bpe.split(text) == bpe._SPLIT.findall(text)


def test_other_tokenizer_files_are_refused(tmp_path):
    import json

    spec = json.load(open(bpe.default_path()))
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": spec["pre_tokenizer"] | {"add_prefix_space": True}}):
        with pytest.raises(ValueError, match="not supported"):
            bpe.Codec(json.dumps(spec | change).encode())
