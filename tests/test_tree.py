"""Trees deeper and larger than the registered ones."""

import random

import pytest

from fluvia.operators import tree


def test_parents_of_deep_rows(spark):
    levels = [*range(46), 44, 41, 42]
    rows = [("s", i, "  " * x + "n", str(i)) for i, x in enumerate(levels)]
    found = tree.recover_parents(spark.createDataFrame(rows, "sample_id string, row_no int, name string, taxid string"), ["sample_id"])
    parents = {r.row_no: r.parent for r in found.collect()}
    assert parents == {i: next((str(j) for j in reversed(range(i)) if levels[j] < x), None) for i, x in enumerate(levels)}


def test_ancestors_of_a_deep_tree(spark):
    rows = [(str(i), str(i - 1) if i else None) for i in range(150)] + [("x", "x"), ("y", "outside"), ("z", "140")]
    found = tree.ancestors(spark.createDataFrame(rows, "taxid string, parent string")).collect()
    chain = [(str(i), str(j)) for i in range(150) for j in range(i + 1)]
    expected = [*chain, ("x", "x"), ("y", "y"), ("y", "outside"), ("z", "z"), *(("z", str(j)) for j in range(141))]
    assert sorted(map(tuple, found)) == sorted(expected)
    with pytest.raises(ValueError):
        tree.ancestors(spark.createDataFrame([("a", "b"), ("b", "a")], "taxid string, parent string"))


def plain_order(rows):
    """{taxid: (row_no, depth)} of (taxid, parent, cumul)."""
    known = {t for t, _, _ in rows}
    children = {}
    for t, p, c in rows:
        children.setdefault(p if p in known and p != t else None, []).append((-(c or 0), t))
    out, todo = {}, [(0, t) for _, t in sorted(children.get(None, []), reverse=True)]
    while todo:
        depth, t = todo.pop()
        out[t] = len(out) + 1, depth
        todo += [(depth + 1, c) for _, c in sorted(children.get(t, []), reverse=True)]
    for t in sorted(known - out.keys()):
        out[t] = len(out) + 1, None
    return out


SCHEMA = "sample_id string, taxid string, parent string, cumul long"


def test_depth_first_order(spark):
    rng = random.Random(6)
    trees = {"chain": [(f"{i:05d}", f"{i - 1:05d}" if i else None, 5) for i in range(3000)], "empty": [("1", None, None)]}
    trees["wide"] = [("r", "r", 9)] + [(str(i), "r", rng.randint(0, 5)) for i in range(500)]
    trees["cycles"] = [("a", "b", 1), ("b", "a", 2), ("c", "a", 3), ("r", None, 1), ("s", "missing", 8), ("t", "r", 0)]
    trees["only cycles"] = [("a", "b", 1), ("b", "a", 2)]
    for k in range(4):
        trees[f"random {k}"] = [(str(i), rng.choice([None, str(i), "none", *map(str, range(max(0, i - 9), i))]), rng.randint(0, 4)) for i in range(400)]
    df = spark.createDataFrame([(k, *r) for k, rows in trees.items() for r in rows], SCHEMA).repartition(4)
    found = {}
    for r in tree.depth_first(df, ["sample_id"]).collect():
        found.setdefault(r.sample_id, {})[r.taxid] = r.row_no, r.depth
    assert found == {k: plain_order(rows) for k, rows in trees.items()}
    assert tree.depth_first(df.limit(0), ["sample_id"]).count() == 0


def test_parents_of_odd_indents_and_repeated_rows(spark):
    rows = [(" a", "1"), ("b", "2"), (" c", "3"), ("   d", "4"), ("  e", "5"), (" f", "6"), ("      g", "4"), ("h", "7")]
    found = tree.recover_parents(spark.createDataFrame([("s", i, n, t) for i, (n, t) in enumerate(rows)], "sample_id string, row_no int, name string, taxid string"), ["sample_id"])
    assert [(r.taxid, r.parent) for r in found.orderBy("row_no").collect()] == [("1", None), ("2", None), ("3", "2"), ("4", "3"), ("5", "3"), ("6", "2"), ("4", "3"), ("7", None)]
    assert tree.recover_parents(found.limit(0), ["sample_id"]).count() == 0
