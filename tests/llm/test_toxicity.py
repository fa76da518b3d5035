"""The fit of the toxicity model takes its features in blocks."""

import tracemalloc

import numpy as np

from bondscope.llm import toxicity


def drawn(rows, features, of):
    rng = np.random.default_rng(11)
    found = [np.unique(rng.integers(0, of, features)).astype(np.int32) for _ in range(rows)]
    return found, np.array([int(f[0] < of // 25) + int(f[0] < of // 100) for f in found])


def test_memory_of_the_fit_is_about_that_of_the_features(monkeypatch):
    monkeypatch.setattr(toxicity, "ROUNDS", 2)
    found, grades = drawn(4000, 500, 5000)
    tracemalloc.start()
    toxicity.fit(found, grades)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 1.9 million features of 4 bytes, tables of all features, one block.
    assert most < 40e6


def test_blocks_do_not_change_the_model(monkeypatch):
    monkeypatch.setattr(toxicity, "ROUNDS", 20)
    found, grades = drawn(300, 12, 200)
    found[7] = found[7][:0]
    models = []
    for block in (1 << 17, 1, 50):
        monkeypatch.setattr(toxicity, "BLOCK", block)
        models.append(toxicity.fit(found, grades))
    assert len(models[0][0]) and len(models[0][2]) == 2
    for model in models[1:]:
        assert all(np.array_equal(x, y) for x, y in zip(model, models[0]))


def test_fit_without_rows_or_words():
    none = np.empty(0, dtype=np.int32)
    assert [len(x) for x in toxicity.fit([], np.empty(0, dtype=np.int64))] == [0, 0, 0]
    names, weight, cuts = toxicity.fit([none] * 6, np.array([0, 1, 0, 0, 1, 0]))
    assert len(names) == len(weight) == 0 and len(cuts) == 1
