"""Byte-level BPE by a tokenization automaton.

The automaton is compiled over tokens and run over bytes. Over tokens it starts as one state with an arc for each byte
and takes the merges in order; the gadget of merge (u, v) -> w adds, from each state with a path u v, an arc w to where
the path led, and takes the arc v away from the state that u leads to, split off for that. All arcs with one label lead
to one state, so the states are the last tokens, and the arcs of w's state are those that v's state had when the merge
came. The arcs are kept that way, as arrays: for each state, the state it was split from and when, and the arcs taken
away (the merge rules). A token sequence is the encoding of its bytes if and only if the automaton reads it.

Over bytes an arc is spelled out along its label, by a table (node, byte) -> node of the beginnings of all labels; it is
kept as a sorted list of its entries, as nearly all of (node, byte) are none and each Python worker has a copy. One path at most spells each beginning of a word, so every place in a word has one state: the words of a slice are read
side by side, a byte a step, without going back, and each place keeps the arc that led to it. Decoding emits the labels
of the arcs. Words that came up lately are kept with their ids.

Defined cases: a null text is empty and has no tokens; repeated rows get one row each; special tokens that occur
in a text are one token; ids stay whole for texts of any length (words longer than the longest token included).
Tokenizer files with a normaliser, an added prefix space, tokens that take in blanks, or options of the model that
change its merges are refused.
"""

from __future__ import annotations

import functools
import json
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, slices

#: Fixed value: the pattern that splits a text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

LONG, WORDS, FEW_WORDS, SLICE_BYTES = 64, 1 << 18, 1 << 16, 1 << 20


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files, and its byte."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def splitter(end: int) -> re.Pattern:
    """PATTERN for texts without code points from `end` on (0x10000 at most), its classes written out."""
    points = "".join(map(chr, [*range(min(end, 0xD800)), *range(0xE000, max(end, 0xE000))]))
    ranges = lambda p: "".join(f"\\u{ord(m[0][0]):04x}-\\u{ord(m[0][-1]):04x}" for m in regex.finditer(p + "+", points))
    letter, digit, blank = map(ranges, (r"\p{L}", r"\p{N}", r"\p{White_Space}"))
    pattern = PATTERN.replace(r"\P{White_Space}", f"[^{blank}]").replace(r"[^\p{White_Space}\p{L}\p{N}]", f"[^{blank}{letter}{digit}]")
    return re.compile(pattern.replace(r"\p{L}", f"[{letter}]").replace(r"\p{N}", f"[{digit}]").replace(r"\p{White_Space}", f"[{blank}]"))


_SPLIT = regex.compile(PATTERN)


def split(text: str) -> list[str]:
    if text.isascii():
        return splitter(0x80).findall(text)
    if len(text.encode("utf-16-le")) == 2 * len(text):
        return splitter(0x10000).findall(text)
    return _SPLIT.findall(text)


class Automaton:
    """tokens: the bytes of each token by id; merges: pairs of ids in order."""

    def __init__(self, tokens: dict[int, bytes], merges: list[tuple[int, int]]):
        ids = {t: i for i, t in tokens.items()}
        self.size = max(tokens, default=0) + 1
        made = {ids[bytes([b])]: -1 for b in range(256)}  # when each state came to be
        left: dict[int, int] = {}
        right: dict[int, int] = {}  # the state that a merged token's state was split from
        taken: dict[int, int] = {}  # arcs taken away, and when
        size = self.size

        def has(p: int, x: int, now: int) -> bool:
            """Whether state p has an arc x after merge number `now`."""
            while taken.get(p * size + x, now + 1) > now:
                born, came = made.get(p), made.get(x)
                if born is None or came is None:
                    return False
                if born > came:
                    p, now = right[p], born - 1
                elif came >= 0:
                    x, now = left[x], came  # of three equal tokens in a row the first two merge
                else:
                    return True
            return False

        for k, (u, v) in enumerate(merges):
            w = ids[tokens[u] + tokens[v]]
            if w in made or not has(u, v, k - 1):
                continue  # no path u v is left: the gadget adds nothing
            made[w], left[w], right[w] = k, u, v
            taken[u * size + v] = k
        at = np.fromiter(made, np.int64, len(made))
        self.made, self.left, self.right = np.full(size, -2, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.made[at] = np.fromiter(made.values(), np.int64, len(made))
        self.left[np.fromiter(left, np.int64, len(left))] = np.fromiter(left.values(), np.int64, len(left))
        self.right[np.fromiter(right, np.int64, len(right))] = np.fromiter(right.values(), np.int64, len(right))
        keys = np.array(sorted(taken), np.int64)
        self.gone = np.append(keys, np.int64(1) << 62)
        self.gone_at = np.array([*map(taken.__getitem__, keys.tolist()), 1 << 62], np.int64)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self._spot(keys)] = True
        self._spell({tokens[i]: i for i in made})

    @staticmethod
    def _spot(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)

    def _spell(self, live: dict[bytes, int]) -> None:
        """The table (node, byte) -> node of the beginnings of the tokens; node 0 is the empty one, -1 none. Nodes that
        go on have numbers below inner."""
        inner = {t[:n] for t in live for n in range(len(t))}
        number = {t: i for i, t in enumerate(sorted(inner))} | {t: len(inner) + i for i, t in enumerate(sorted(live.keys() - inner))}
        self.inner = len(inner)
        self.token = np.fromiter((live.get(t, -1) for t in number), np.int32, len(number))
        steps = sorted((number[t[:-1]] << 8 | t[-1], i) for t, i in number.items() if t)
        self.steps = array("i", [k for k, _ in steps] + [(1 << 31) - 1])
        self.nodes = np.array([i for _, i in steps] + [-1], np.int32)

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        key = node << 8 | byte
        steps = np.frombuffer(self.steps, np.int32)
        at = np.searchsorted(steps, key.astype(np.int32))
        return np.where(steps[at] == key, self.nodes[at], -1).astype(np.int64)

    def arcs(self, p: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Whether each state p has the arc x; any label leads from the start, p = -1."""
        out = p < 0
        at = np.flatnonzero(~out)
        p, x, now = p[at].astype(np.int64), x[at].astype(np.int64), np.full(len(at), 1 << 60, np.int64)
        while len(at):
            key = p * self.size + x
            ok = np.ones(len(at), bool)
            some = np.flatnonzero(self.maybe[self._spot(key)])
            place = np.searchsorted(self.gone, key[some])
            ok[some[(self.gone[place] == key[some]) & (self.gone_at[place] <= now[some])]] = False
            born, came = self.made[p], self.made[x]
            back = born > came
            done = ok & ~back & (came < 0)
            out[at[done]] = True
            go = ok & ~done
            back, at, p, x, born, came = back[go], at[go], p[go], x[go], born[go], came[go]
            now = np.where(back, born - 1, came)
            p, x = np.where(back, self.right[p], p), np.where(back, x, self.left[x])
        return out

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word (of one byte at least) as little-endian 32-bit integers."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-lengths, kind="stable")
        n = lengths[order]
        data = np.frombuffer(b"".join([words[i] for i in order.tolist()]), np.uint8)
        base = np.cumsum(n) - n  # of word i's bytes; its places 0 .. n are from base[i] + i on
        places = base + np.arange(len(n))
        state = np.full(len(data) + len(n), -1, np.int32)
        since = np.zeros(len(state), np.int64)
        word, start, node = (np.empty(0, np.int64) for _ in range(3))
        for e in range(int(n[0]) if len(n) else 0):
            more = int(np.searchsorted(-n, -e, "left"))  # words of more than e bytes
            stay = word < more
            word = np.concatenate([word[stay], np.arange(more)])
            start = np.concatenate([start[stay], places[:more] + e])
            node = np.concatenate([node[stay], np.zeros(more, np.int64)])
            node = self.step(node, data[base[word] + e])
            on = np.flatnonzero(node >= 0)
            word, start, node = word[on], start[on], node[on]
            hit = np.flatnonzero(self.token[node] >= 0)
            label = self.token[node[hit]]
            good = self.arcs(state[start[hit]], label)
            to = places[word[hit[good]]] + e + 1
            state[to], since[to] = label[good], start[hit[good]]
            on = np.flatnonzero(node < self.inner)
            word, start, node = word[on], start[on], node[on]
        ends = np.zeros(len(state), bool)
        at = (places + n)[n > 0]
        while len(at):
            ends[at] = True
            at = since[at]
            at = at[state[at] >= 0]
        ids = state[ends].astype("<u4").tobytes()
        bounds = np.append(0, np.cumsum(ends) * 4)[np.append(places, len(state))].tolist()
        out = [b""] * len(n)
        for i, s, t in zip(order.tolist(), bounds, bounds[1:]):
            out[i] = ids[s:t]
        return out

    def encode_long(self, word: bytes) -> bytes:
        """The same for one word, by a plain loop with the arcs known lately: each step of the table costs little."""
        steps, nodes, token, state, since, live = self.steps, self.nodes, self.token, [-1], [0], []
        known: dict[tuple[int, int], bool] = {}
        for e, b in enumerate(word):
            state.append(-1)
            since.append(0)
            on = []
            for s, v in [*live, (e, 0)]:
                at = bisect_left(steps, v << 8 | b)
                if steps[at] != v << 8 | b:
                    continue
                v = int(nodes[at])
                x = int(token[v])
                if x >= 0:
                    key = (state[s], x)
                    if key not in known:
                        if len(known) > 1 << 16:
                            known.clear()
                        known[key] = bool(self.arcs(np.array([key[0]]), np.array([x]))[0])
                    if known[key]:
                        state[-1], since[-1] = x, s
                if v < self.inner:
                    on.append((s, v))
            live = on
        out, at = [], len(word)
        while at:
            out.append(state[at])
            at = since[at]
        return np.array(out[::-1], "<u4").tobytes()


class Codec:
    def __init__(self, spec: bytes):
        """spec: the text of a tokenizer file (byte-level BPE)."""
        parsed = json.loads(spec)
        model, before = parsed["model"], parsed.get("pre_tokenizer") or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        odd += [k for k in ("normalizer", "post_processor") if parsed.get(k)]
        if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            odd.append("pre_tokenizer")
        if any(x.get("lstrip") or x.get("rstrip") or x.get("single_word") for x in parsed.get("added_tokens", [])):
            odd.append("added_tokens")
        if odd:
            raise ValueError(f"a tokenizer file with these settings is not supported: {', '.join(odd)}")
        letter = byte_letters()
        tokens = {i: bytes(map(letter.__getitem__, t)) for t, i in model["vocab"].items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.special = {x["content"]: x["id"] for x in parsed.get("added_tokens", [])}
        plain = {i: t for i, t in tokens.items() if i not in set(self.special.values())}
        self.automaton = Automaton(plain, [(model["vocab"][u], model["vocab"][v]) for u, v in pairs])
        self.apart = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        label = tokens | {i: s.encode() for s, i in self.special.items()}
        ordered = [label.get(i, b"") for i in range(max(label, default=-1) + 1)]
        self.labels = np.frombuffer(b"".join(ordered), np.uint8)
        self.label_at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ordered), np.int64, len(ordered)))])
        self.label_size = np.diff(self.label_at)
        self.words: dict[str, bytes] = {}

    def learn(self, texts: Iterable[list[str]], most: int = WORDS) -> None:
        """Encode the words of texts that are not known yet. Of more than `most` known, only these texts' are kept."""
        now = set().union(*texts)
        if len(self.words) > most:
            self.words = {w: x for w, x in self.words.items() if w in now}
        new = [w for w in now if w not in self.words]
        raw = [w.encode() for w in new]
        long = [i for i, b in enumerate(raw) if len(b) > LONG]
        self.words.update((new[i], self.automaton.encode_long(raw[i])) for i in long)
        if long:
            new, raw = [w for w, b in zip(new, raw) if len(b) <= LONG], [b for b in raw if len(b) <= LONG]
        self.words.update(zip(new, self.automaton.encode_words(raw)))

    def parts(self, text: str) -> list[str]:
        """The words and special tokens of a text."""
        if self.apart is None or not any(s in text for s in self.special):
            return split(text)
        return [w for x in self.apart.split(text) for w in ([x] if x in self.special else split(x))]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        parts = [self.parts(x) for x in texts]
        self.learn(parts, FEW_WORDS)
        self.words.update((s, np.array([i], "<u4").tobytes()) for s, i in self.special.items())
        return [b"".join(map(self.words.__getitem__, x)) for x in parts]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def decode_many(self, ids: list[bytes]) -> list[str]:
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        size = self.label_size[flat]
        ends = np.append(0, np.cumsum(size))
        data = self.labels[np.arange(ends[-1]) + np.repeat(self.label_at[flat] - ends[:-1], size)].tobytes()
        bounds = ends[np.cumsum([0, *(len(x) // 4 for x in ids)])].tolist()
        return [data[s:e].decode("utf-8", "replace") for s, e in zip(bounds, bounds[1:])]

    def decode(self, ids: bytes) -> str:
        return self.decode_many([ids])[0]


@functools.lru_cache(maxsize=2)
def _codec(spec: bytes) -> Codec:
    return Codec(spec)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """(doc_id, ids), ids as little-endian 32-bit integers; with decode also the text made from them.

    The tokenizer file (its size is that of a vocabulary) is read once by the driver and broadcast.
    """
    with open(path or default_path(), "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(spec.value)
        for part in slices(batches, max_bytes=SLICE_BYTES):
            ids = codec.encode_many([x or "" for x in part.column(1).to_pylist()])
            columns = [part.column(0), pa.array(ids, pa.binary())]
            if decode:
                columns.append(pa.array(codec.decode_many(ids), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, ids binary" + ", decoded string" * decode)


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    out = encode(read_table(spark, sf_dir, "documents"), decode=True)
    return out.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
