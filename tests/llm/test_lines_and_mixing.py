"""Line chunks against a plain search, and mixtures against their definition."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fluvia.llm import linededup, mixing


def test_repeated_chunks_go(spark):
    rng = random.Random(11)
    line = lambda: " ".join(rng.choices(["ab", "cd", "é", "x", "yz"], k=rng.randint(0, 8)))
    shared = [[line() for _ in range(rng.randint(4, 20))] for _ in range(5)]
    rows = []
    for i in range(60):
        parts = [line() for _ in range(rng.randint(0, 10))]
        for _ in range(rng.randint(0, 2)):
            parts += rng.choice(shared) + [line() for _ in range(rng.randint(0, 6))]
        rows.append((i, "\n".join(parts)))
    rows += [(70, None), (71, ""), (None, rows[0][1]), (0, rows[0][1]), (72, "\n\n\n")]
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, _key int").repartition(4)
    found = linededup.dedup_lines(docs)
    assert found.columns == docs.columns
    plain = without_copies({(i, t) for i, t in rows if i is not None and t})
    expected = {(i, t): plain[i] for i, t in rows if i in plain}
    got = defaultdict(list)
    for r in found.collect():
        got[r.doc_id].append(r.text)
    for i, t in rows:
        assert expected.get((i, t), t) in got[i], i
    assert sum(map(len, got.values())) == len(rows) and any(expected[k] != k[1] for k in expected)
    assert linededup.dedup_lines(docs.limit(0)).count() == 0
    assert {r._key for r in found.collect()} == {5}


def test_texts_are_cut_by_builtin_functions(spark):
    """Whole batches of texts, old and new, in Python workers are what took an executor over its memory."""
    a, b = "é one\ntwo €\n\n", "x\ny"
    docs = spark.createDataFrame([(1, a + "own"), (2, "first\n" + a + b), (3, b), (4, a[:-2]), (5, "own\n" + b + "\n")], "doc_id long, text string")
    found = linededup.dedup_lines(docs, counts=("runs", "bytes"))
    assert {r.doc_id: (r.text, r.runs, r.bytes) for r in found.collect()} == {1: (a + "own", 0, 0), 2: ("first\n\n" + b, 1, 15), 3: ("", 1, 3), 4: ("", 1, 14), 5: ("own\n", 1, 4)}
    assert not any(x in found._jdf.queryExecution().toString() for x in ("Python", "InArrow"))


def test_boundaries_resist_shifts():
    lines = [f"line {i * i % 97}".encode() for i in range(200)]

    def cut(x):
        text = b"\n".join(x)
        return {text[s:e] for kind, s, e, _ in linededup.pieces(text) if kind == linededup.CHUNK}

    assert len(cut(lines)) > 10 and len(cut(lines) & cut([b"one more", *lines])) >= len(cut(lines)) - 2


def test_chunks_and_pairs_cover_each_other():
    """Each two neighbouring lines are one piece, in the chunk that holds both or in none."""
    text = "\n".join(["", "a", "b", " ", "c"] + [f"row {i}" for i in range(100)]).encode()
    lines = linededup.worded(text)
    found = linededup.pieces(text)
    chunks = {s: e for kind, s, e, _ in found if kind == linededup.CHUNK}
    pairs = [(s, e, c) for kind, s, e, c in found if kind == linededup.PAIR]
    assert [p[:2] for p in pairs] == [(a[0], b[1]) for a, b in zip(lines, lines[1:])]
    assert all(c == -1 or (c <= s and e <= chunks[c]) for s, e, c in pairs) and all(not any(c <= s and e <= d for c, d in chunks.items()) for s, e, x in pairs if x == -1)


@pytest.mark.parametrize("window, divisor", [(1, 1), (1, 2), (2, 3), (3, 1000)])
def test_result_does_not_depend_on_boundaries(spark, window, divisor):
    rng = random.Random(divisor)
    line = lambda: f"w{rng.randrange(12)}"
    passages = [[line() for _ in range(rng.randint(2, 12))] for _ in range(6)]
    rows = []
    for i in range(80):
        parts = [line() for _ in range(rng.randint(0, 3))]
        for _ in range(rng.randint(1, 3)):
            parts += rng.choice(passages) + [line() + str(rng.randrange(50))]
        rows.append((i, "\n".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.text for r in linededup.dedup_lines(docs, window=window, divisor=divisor).collect()} == without_copies(rows)


@pytest.fixture(scope="module")
def mixture(spark):
    rng = random.Random(13)
    rows = [(i, rng.choices(["a", "b", "c", None], [30, 6, 2, 1])[0], "w " * rng.randint(1, 60)) for i in range(800)] + [(900, "empty", ""), (901, "empty", None), (902, "a", "x y"), (902, "a", "x y")]
    return spark.createDataFrame(rows, "doc_id long, source string, text string"), rows


def test_weights_meet_their_target(spark, mixture):
    docs, _ = mixture
    sources = mixing.totals(docs).groupBy("source").agg(F.sum("tokens").alias("tokens"))
    total = {r.source: r.tokens for r in sources.collect()}
    share = [t / sum(total.values()) for t in total.values() if t]
    target = 0.9 * math.log(len(share))
    a = mixing.fit(sources, entropy=target)
    weights = {r.source: r.weight for r in mixing.weights(sources, a).collect()}
    assert sum(weights.values()) == pytest.approx(1) and weights["empty"] == 0
    assert -sum(w * math.log(w) for w in weights.values() if w) == pytest.approx(target, abs=1e-6)
    a = mixing.fit(sources, budget=sum(total.values()), most_repeats=1.5)
    weights = {r.source: r.weight for r in mixing.weights(sources, a).collect()}
    assert max(weights[s] * sum(total.values()) / t for s, t in total.items() if t) == pytest.approx(1.5, rel=1e-6)


def test_every_row_is_drawn_and_none_too_often(spark, mixture):
    docs, rows = mixture
    found = mixing.mix(docs)
    n = Counter((r.doc_id, r.source) for r in found.collect())
    assert set(n) == {(i, s) for i, s, _ in rows}
    assert n[902, "a"] % 2 == 0 and max(n[i, s] for i, s, _ in rows if i != 902) <= 2
    assert {(r._epoch >= 0, 0 <= r._place <= 1) for r in found.collect()} == {(True, True)}
    assert mixing.mix(docs.limit(0)).count() == 0


def test_a_budget_is_met_at_the_weights(spark, mixture):
    docs, _ = mixture
    found = mixing.mix(docs, budget=6000.0, entropy_share=0.99, most_repeats=None)
    got = {r.source: r.n for r in found.groupBy("source").agg(F.sum(mixing.n_tokens(F.col("text"))).alias("n")).collect()}
    sources = mixing.totals(docs).groupBy("source").agg(F.sum("tokens").alias("tokens"))
    a = mixing.fit(sources, 6000.0, 0.99 * math.log(4))
    for r in mixing.weights(sources, a).collect():
        if r.weight:
            assert got[r.source] == pytest.approx(r.weight * 6000, abs=200)


def without_copies(rows):
    """By hand: a line goes if it and a worded neighbour, with what is between, stand earlier too."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        lines = t.split("\n")
        worded = [k for k, x in enumerate(lines) if x.strip()]
        gone = set()
        for a, b in zip(worded, worded[1:]):
            window = tuple(lines[a : b + 1])
            if window in seen:
                gone |= set(range(a, b + 1))
            seen.add(window)
        ends = ["\n"] * (len(lines) - 1) + [""]
        out[i] = "".join(x + e for k, (x, e) in enumerate(zip(lines, ends)) if k not in gone)
    return out


def test_planted_runs_of_any_length_go(spark):
    rng = random.Random(17)
    line = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(5))
    rows, planted = [], {}
    for n in range(2, 11):
        for k in range(10):
            run = [line() for _ in range(n)]
            if k % 3 == 0:
                run.insert(1, "")
            for copy in range(2):
                own = [line() for _ in range(rng.randint(0, 5))], [line() for _ in range(rng.randint(0, 5))]
                rows.append((len(rows), "\n".join([*own[0], *run, *own[1]])))
                if copy:
                    planted[len(rows) - 1] = len(run), "\n".join([*own[0], *own[1]])
    rows += [(900, "x y\nx y\nx y\nz"), (901, "a b\nc d\n\ne f"), (902, "c d\n\ne f\ng h\n"), (903, "")]
    docs = spark.createDataFrame([*rows, rows[1]], "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in linededup.dedup_lines(docs, counts=("_chunks", "_removed_bytes")).collect()}
    expected = without_copies(rows)
    assert {i: r.text for i, r in found.items()} == expected
    assert all(found[i].text.strip("\n") == own for i, (_, own) in planted.items())
    assert all(found[i]._chunks == 1 and found[i]._removed_bytes == len(dict(rows)[i]) - len(found[i].text) for i in planted)
    assert found[900].text == "x y\nz" and found[900]._chunks == 1 and found[902].text == "g h\n" and found[901]._chunks == 0


CLASHING = ("_key", "_k", "_own", "_spans", "_starts", "_ends", "_left", "_s", "_b", "_draws", "_draw", "_block", "_epoch", "_place", "_id", "_text")


def test_columns_of_any_name_keep_their_values(spark):
    rows = [(i, "one line here\nanother line\nthird " + str(i % 3), "ab"[i % 2], *(100 * i + j for j in range(len(CLASHING)))) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{c} int" for c in CLASHING))
    for found in (linededup.dedup_lines(docs), mixing.mix(docs).select(*docs.columns).distinct()):
        assert found.schema == docs.schema
        assert sorted((r.doc_id, *(r[c] for c in CLASHING)) for r in found.collect()) == sorted((r[0], *r[3:]) for r in rows)
    assert mixing.mix(docs).columns[-3:] == ["__epoch", "__block", "__place"]


def test_a_mixture_is_that_of_a_plain_version(spark):
    rng = random.Random(23)
    rows = [(i, rng.choices("abcd", [40, 9, 3, 1])[0], "w " * rng.randint(0, 40)) for i in range(500)]
    rows += [(i, s, t) for i, s, t in rows[:20]] + [(999, None, "some words of no source"), (998, "a", "w " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    blocks = 16
    named = {(r.doc_id, r.text): r.b for r in docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("b")).collect()}
    order = {(r.e, r.b): r.h for r in spark.sql(f"select e, b, xxhash64(7, e, b) as h from (select cast(id as int) e from range(40)) cross join (select cast(id as int) b from range({blocks}))").collect()}
    tokens = Counter()
    for i, s, t in rows:
        tokens[s, named[i, t]] += len(t.split())
    total = Counter()
    for (s, _), n in tokens.items():
        total[s] += n
    p = {s: n / sum(total.values()) for s, n in total.items()}
    power = lambda a: {s: x**a / sum(y**a for y in p.values()) for s, x in p.items()}
    lo, hi = 0.0, 1.0
    for _ in range(60):  # the greatest exponent whose entropy is high enough
        a = (lo + hi) / 2
        lo, hi = (a, hi) if -sum(w * math.log(w) for w in power(a).values()) >= 0.95 * math.log(len(p)) else (lo, a)
    lo, hi = lo, 1.0
    repeats = lambda a: max(power(a)[s] / p[s] for s in p) / min(power(a)[s] / p[s] for s in p)
    if repeats(lo) > 2:
        for _ in range(60):
            a = (lo + hi) / 2
            lo, hi = (lo, a) if repeats(a) <= 2 else (a, hi)
        lo = hi
    weight = power(lo)
    budget = max(total[s] / weight[s] for s in total)
    expected = Counter()
    for s in total:
        own = sorted(b for s2, b in tokens if s2 == s)
        quota, before, epoch = weight[s] * budget, 0, 0
        while before < quota * (1 - 1e-9) or epoch == 0:
            for b in sorted(own, key=lambda b: (order[epoch, b], b)):
                if before < quota * (1 - 1e-9) or before + tokens[s, b] <= quota * (1 + 1e-9):
                    expected[s, b, epoch] += 1
                before += tokens[s, b]
            epoch += 1
    found = mixing.mix(docs, blocks=blocks, seed=7).collect()
    assert Counter((r.source, r._block, r._epoch) for r in found).keys() == expected.keys()
    per = Counter((s, named[i, t], i, t) for i, s, t in rows)
    assert Counter((r.source, r._block, r._epoch, r.doc_id, r.text) for r in found) == Counter({(s, b, e, i, t): n for s, b, e in expected for (s2, b2, i, t), n in per.items() if (s, b) == (s2, b2)})


def test_a_first_pass_of_long_texts_and_ties(spark):
    long = "\n".join(f"row {i} of the long text" for i in range(20000))
    docs = spark.createDataFrame([(1, long), (2, "before\n" + long + "\nafter"), (3, "x y\nx y\nx y")], "doc_id long, text string")
    found = {r.doc_id: r.text for r in linededup.dedup_lines(docs).collect()}
    assert found == {1: long, 2: "before\nafter", 3: "x y\n"}
