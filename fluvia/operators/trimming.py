"""Adapters with errors: cut from reads' ends, and reads split where one lies inside.

An occurrence is told by its end: E(a, j) is the least edit distance between adapter a and any part of the read that ends
after j letters. It is found bit-parallel (Myers' recurrence), an adapter's rows in the bits of a word and many stretches of
reads side by side; each stretch begins so far before its first end that what lies earlier cannot matter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WIDTH = 512
_CELLS = 1 << 22


def occurrences(texts: list[np.ndarray], adapter: bytes, errors: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, end, distance) of all ends with E of at most `errors`; texts are arrays of bytes, adapters have 64 at most."""
    size = len(adapter)
    if not 1 <= size <= 64 or not 0 <= errors < size:
        raise ValueError("an adapter has 1 to 64 letters, and fewer errors than letters")
    before = size + errors
    width = min(_WIDTH, max(map(len, texts), default=1) or 1)  # short reads make short stretches
    found, rows, marks, held = [], [], [], 0

    def search() -> None:
        nonlocal rows, marks, held
        if rows:
            cells = np.ascontiguousarray(np.concatenate(rows).T)
            number, first, length = (np.concatenate(x) for x in zip(*marks))
            for end, distance in _scan(cells, adapter, before):
                hit = np.flatnonzero((distance <= errors) & (first + end <= length))
                found.append((number[hit], first[hit] + end, distance[hit]))
        rows, marks, held = [], [], 0

    for i, text in enumerate(texts):
        stretches = -(-len(text) // width)
        if not stretches:
            continue
        padded = np.zeros(before + stretches * width, np.uint8)
        padded[before : before + len(text)] = text
        every = np.lib.stride_tricks.sliding_window_view(padded, before + width)[::width]
        for j in range(0, stretches, _CELLS // (before + width)):
            part = every[j : j + _CELLS // (before + width)]
            if held + part.size > _CELLS:
                search()
            rows.append(part)
            marks.append((np.full(len(part), i), (j + np.arange(len(part))) * width, np.full(len(part), len(text))))
            held += part.size
    search()
    if not found:
        return (np.zeros(0, np.int64),) * 3
    text, end, distance = (np.concatenate(x).astype(np.int64) for x in zip(*found))
    order = np.lexsort((end, text))
    return text[order], end[order], distance[order]


def _scan(cells: np.ndarray, adapter: bytes, skip: int):
    """(end, distances) after each letter from place `skip` on; cells: letters x stretches. A zero letter is like none."""
    one = np.uint64(1)
    last = np.uint64(len(adapter) - 1)
    equal = np.zeros(256, np.uint64)
    for i, c in enumerate(adapter):
        equal[c] |= one << np.uint64(i)
    equal[0] = 0
    up = np.full(cells.shape[1], ~np.uint64(0))
    down = np.zeros(cells.shape[1], np.uint64)
    distance = np.full(cells.shape[1], len(adapter), np.int64)
    for place, letters in enumerate(cells):
        eq = equal[letters]
        across = (((eq & up) + up) ^ up) | eq
        more, less = down | ~(across | up), up & across
        distance += ((more >> last) & one).astype(np.int64) - ((less >> last) & one).astype(np.int64)
        more, less = more << one, less << one
        up, down = less | ~(eq | down | more), more & (eq | down)
        if place >= skip:
            yield place - skip + 1, distance


def _best_end(texts: list[np.ndarray], adapters: list[bytes], share: float) -> np.ndarray:
    """How much of each text to cut from its start: of each adapter the end of least distance (ties: the furthest), of
    these the furthest; 0 where none is near enough."""
    cut = np.zeros(len(texts), np.int64)
    for a in adapters:
        text, end, distance = occurrences(texts, a, int(len(a) * share))
        order = np.lexsort((-end, distance, text))
        first = order[np.append(True, np.diff(text[order]) > 0)] if len(order) else order
        np.maximum.at(cut, text[first], end[first])
    return cut


def pieces(texts: list[str | None], adapters: list[str], window: int, end_share: float, inner_share: float, least: int) -> list[list[tuple[int, int]]]:
    """(start, size) of what stays of each text; see split_reads()."""
    own = [np.frombuffer((t or "").encode("ascii", "replace"), np.uint8) for t in texts]
    heads = _best_end([t[:window] for t in own], [a.encode() for a in adapters], end_share)
    rest = [t[h:] for t, h in zip(own, heads)]
    tails = _best_end([t[::-1][:window] for t in rest], [a.encode()[::-1] for a in adapters], end_share)
    body = [t[: len(t) - n] for t, n in zip(rest, tails)]
    spans: dict[int, list[tuple[int, int]]] = {}
    for a in adapters:
        text, end, distance = occurrences(body, a.encode(), int(len(a) * inner_share))
        run = np.cumsum(np.append(0, (np.diff(end) != 1) | (np.diff(text) != 0))[: len(end)])
        order = np.lexsort((-end, distance, run))
        best = order[np.append(True, np.diff(run[order]) > 0)] if len(order) else order
        text, end = text[best], end[best]
        for i, e in zip(text.tolist(), end.tolist()):
            spans.setdefault(i, []).append((max(0, e - len(a)), e))
    out = []
    for i, t in enumerate(body):
        kept, at = [], 0
        for lo, hi in sorted(spans.get(i, [])):
            if lo > at:
                kept.append((at, lo - at))
            at = max(at, hi)
        kept.append((at, len(t) - at))
        head = int(heads[i])
        out.append([(head + s, n) for s, n in kept if i not in spans or n >= max(least, 1)])
    return out


def split_reads(reads: DataFrame, adapters: list[str], window: int = 150, end_share: float = 0.25, inner_share: float = 0.1, least: int = 1000) -> DataFrame:
    """Reads with `piece` (from 1), without adapters; errors are a share of an adapter's letters, rounded down.

    In the first and then in the last `window` letters each adapter's nearest occurrence goes, with all outside it. Inside,
    as many letters as an adapter has go before the nearest of each run of neighbouring ends (ties: the furthest), and
    what is left between is a piece if it has `least` letters. A read without an adapter inside stays as one piece of any length; null is an empty one.
    """

    @F.pandas_udf("array<struct<start: int, size: int>>")
    def kept(texts: pd.Series) -> pd.Series:
        return pd.Series(pieces(list(texts), adapters, window, end_share, inner_share, least))

    out = reads.select("*", F.posexplode(kept("sequence")).alias("_n", "_at"))
    cut = {c: F.substring(c, F.col("_at.start") + 1, F.col("_at.size")) for c in ("sequence", "quality")}
    return out.withColumns({**cut, "piece": F.col("_n") + 1}).drop("_n", "_at")
