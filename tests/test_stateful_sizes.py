"""Streams whose keys have many rows: no task holds a key, and state is called for a few times."""

from types import SimpleNamespace

import pytest

from fluvia.streaming import batches, stateful

from test_stateful import ITEMS, TAXA, at, plain, put, told


@pytest.mark.parametrize("seconds", [60, None])
def test_batches_of_one_key_are_numbered_by_ranges(spark, tmp_path, monkeypatch, seconds):
    monkeypatch.setattr(stateful, "CountOrTick", None)  # which gathers a key's rows in Python
    rows = [(i // 3, i) for i in range(3000)]
    put(spark, f"{tmp_path}/in", [("a", at(s), i) for s, i in rows], ITEMS)
    found = told(stateful.batched(batches.watch(spark, f"{tmp_path}/in", ITEMS), 7, seconds, f"{tmp_path}/out"))
    assert found == {("a", i): x for i, x in enumerate(plain(rows, 7, seconds))}


def test_reports_of_one_sample_are_not_gathered(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stateful, "RunningTaxa", None, raising=False)
    put(spark, f"{tmp_path}/in", [("s", b, str(t), 1, 2, "S", "x", None) for b in range(5) for t in range(b, 40)], TAXA)
    found = stateful.reported(batches.watch(spark, f"{tmp_path}/in", TAXA), 2, f"{tmp_path}/out").collect()
    own = {(r.batches, int(r.taxid)): (r.reads, r.cumul) for r in found}
    assert len(found) == len(own) and own == {(n, t): (min(n, t + 1), 2 * min(n, t + 1)) for n in (1, 2, 4, 5) for t in range(40)}


def test_a_key_asks_for_its_results_once():
    calls = []
    held = SimpleNamespace(exists=lambda: calls.append("exists"), update=calls.append)
    own = stateful.ByBatch()
    own.init(SimpleNamespace(getValueState=lambda name, schema: held))
    rows = [SimpleNamespace(batch_id=b, arrival=b, total=2, hits=1) for b in range(50)]
    (out,) = own.handleInputRows(("s", "9"), rows, None)
    assert (out.total, out.hits, out.batches[:2]) == (100, 50, ["0", "1"]) and len(calls) == 2
