"""Symmetric trees and ordered statistics against plain numpy."""

import math
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from bondscope.operators import boosting
from bondscope.operators.statistics import (
    category_table, hash_order, ordered_statistics, priors, with_statistics,
)

SETTINGS = boosting.Symmetric(iterations=3, depth=3, bins=8)
FEATURES = ("a", "b", "c")


def rows(n=240, seed=1):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = draw.randrange(6), draw.random() * 100, draw.gauss(0, 1)
        y = 3.0 * (a > 2) + (b > 40) * c + draw.gauss(0, 0.1)
        out.append((i, float(a), b, c, y, -2 * y + b, int(a // 2), int(c > 0)))
    return out


SCHEMA = "id long, a double, b double, c double, y double, z double, kind int, side int"


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(), SCHEMA).cache()


def cuts_of(x, bins):
    values, counts = np.unique(x, return_counts=True)
    upto = counts.cumsum()
    opened = np.floor(upto * bins / len(x)) > np.floor((upto - counts) * bins / len(x))
    return [values[i + 1] for i in range(len(values) - 1) if opened[i]]


def brute(x, truth, classes, settings, scores=None, cuts=None):
    """Trees of one target and the scores after them; ``classes`` 0 for a number."""
    cuts = cuts or [cuts_of(c, settings.bins) for c in x.T]
    bins = np.array([np.searchsorted(k, c, side="right") for k, c in zip(cuts, x.T)])
    if scores is None:
        scores = np.zeros((len(x), classes)) if classes else np.full((len(x), 1), truth.mean())
    trees = []
    for _ in range(settings.iterations):
        if classes:
            p = np.exp(scores - scores.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            g, h = np.eye(classes)[truth] - p, p * (1 - p)
        else:
            g, h = truth[:, None] - scores, np.ones((len(x), 1))
        leaf, levels = np.zeros(len(x), dtype=int), []
        for level in range(settings.depth):
            best = None
            for f in range(len(cuts)):
                gains = []
                for b in range(1, settings.bins):
                    side = leaf * 2 + (bins[f] >= b)
                    gains.append(sum(g[side == s].sum(0) @ g[side == s].sum(0) / ((side == s).sum() + settings.l2)
                                     for s in range(2 ** (level + 1))))
                at = next(i for i, v in enumerate(gains) if v >= max(gains) * (1 - 1e-9))
                if best is None or gains[at] > best[0] * (1 + 1e-9):
                    best = (gains[at], f, at + 1)
            levels.append(best[1:])
            leaf = leaf + (bins[best[1]] >= best[2]) * 2**level
        values = np.zeros((2**settings.depth, g.shape[1]))
        for s in range(len(values)):
            values[s] = settings.learning_rate * g[leaf == s].sum(0) / (h[leaf == s].sum(0) + settings.l2)
        trees.append((tuple(levels), values))
        scores = scores + values[leaf]
    return trees, scores


def arrays(data, *names):
    at = [SCHEMA.split(", ").index(next(c for c in SCHEMA.split(", ") if c.startswith(n + " "))) for n in names]
    return np.array([[r[i] for i in at] for r in data])


def assert_same(model, index, trees):
    assert len(model.trees[index]) == len(trees)
    for mine, (levels, values) in zip(model.trees[index], trees):
        assert mine.levels == levels
        assert np.allclose(np.array(mine.values).T, values, atol=1e-7)


def test_regression_equals_brute_force(table):
    model = boosting.fit(table, FEATURES, ("y", "z"), SETTINGS, ("id",))
    x = arrays(rows(), *FEATURES)
    for i, name in enumerate(("y", "z")):
        trees, scores = brute(x, arrays(rows(), name)[:, 0], 0, SETTINGS)
        assert_same(model, i, trees)
        found = [r[name] for r in boosting.score(model, table, ["id"]).orderBy("id").collect()]
        assert np.allclose(found, scores[:, 0], atol=1e-6)


def test_softmax_equals_brute_force(table):
    model = boosting.fit(table, FEATURES, ("kind", "side"), SETTINGS, ("id",))
    x = arrays(rows(), *FEATURES)
    scored = boosting.score(model, table, ["id"], chances=True).orderBy("id").collect()
    for i, (name, classes) in enumerate((("kind", 3), ("side", 2))):
        trees, scores = brute(x, arrays(rows(), name)[:, 0].astype(int), classes, SETTINGS)
        assert_same(model, i, trees)
        assert [r[name] for r in scored] == scores.argmax(1).tolist()
        chances = np.exp(scores) / np.exp(scores).sum(1, keepdims=True)
        assert np.allclose([r[f"{name}_chances"] for r in scored], chances, atol=1e-6)


def test_layout_of_the_rows_changes_nothing(table):
    one = boosting.fit(table.coalesce(1), FEATURES, ("y", "z"), SETTINGS, ("id",))
    many = boosting.fit(table.repartition(13, "b"), FEATURES, ("y", "z"), SETTINGS, ("id",))
    assert one.trees == many.trees and one.cuts == many.cuts


def test_stored_states_change_nothing(table, monkeypatch):
    whole = boosting.fit(table, FEATURES, ("y",), SETTINGS, ("id",))
    monkeypatch.setattr(boosting, "TREES_PER_STATE", 1)
    assert boosting.fit(table, FEATURES, ("y",), SETTINGS, ("id",)).trees == whole.trees


def test_going_on_equals_one_run(spark, table, tmp_path):
    whole = boosting.fit(table, FEATURES, ("y", "z"), SETTINGS, ("id",))
    part = boosting.fit(table, FEATURES, ("y", "z"), replace(SETTINGS, iterations=2), ("id",))
    boosting.save(part, spark, str(tmp_path / "m"))
    stored = boosting.load(spark, str(tmp_path / "m"))
    assert stored.trees == part.trees and stored.cuts == part.cuts and stored.targets == part.targets
    longer = boosting.extend(stored, table, 1, ("id",))
    for mine, wanted in zip(longer.trees, whole.trees):
        assert [t.levels for t in mine] == [t.levels for t in wanted]
        assert np.allclose(np.array(mine[-1].values), np.array(wanted[-1].values), atol=1e-9)


def test_awkward_tables(spark, table):
    empty = boosting.fit(table.limit(0), FEATURES, ("y",), SETTINGS, ("id",))
    assert {r.y for r in boosting.score(empty, table, ["id"]).collect()} == {0.0}
    unknown = boosting.fit(table.limit(0), FEATURES, ("kind",), SETTINGS, ("id",))
    assert {r.kind for r in boosting.score(unknown, table, ["id"]).collect()} == {None}
    still = table.withColumns({c: F.lit(1.0) for c in FEATURES})
    flat = boosting.fit(still, FEATURES, ("y",), SETTINGS, ("id",))
    assert flat.trees == ((),) and boosting.score(flat, still, ["id"]).distinct().count() == 240
    gaps = table.withColumn("a", F.when(F.col("id") % 2 == 0, F.col("a")))
    model = boosting.fit(gaps, FEATURES, ("y",), SETTINGS, ("id",))
    assert boosting.score(model, gaps, ["id"]).count() == 120
    one = boosting.fit(table.withColumn("kind", F.lit(7)), FEATURES, ("kind",), SETTINGS, ("id",))
    assert {r.kind for r in boosting.score(one, table, ["id"]).collect()} == {7}


def running_means(data, digits):
    """data: (id, category, y); mean of earlier rows of the category in md5 order."""
    import hashlib
    prior = sum(r[2] for r in data) / len(data)
    order = [(hashlib.md5(str(r[0]).encode()).hexdigest(), r) for r in data]
    out = []
    for o, r in order:
        earlier = [x[2] for p, x in order if x[1] == r[1] and p < o]
        out.append((r[0], (math.fsum(earlier) + prior) / (len(earlier) + 1)))
    return sorted(out)


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_ordered_statistics_equal_brute_force(spark, digits):
    draw = random.Random(5)
    data = [(i % 280, draw.choice(["hot"] * 8 + ["x", "y", None]), draw.random()) for i in range(300)]
    df = spark.createDataFrame(data, "id long, text string, y double")
    found = ordered_statistics(df, ["text"], ["y"], hash_order(["id"]), priors(df, ["y"]), digits)
    got = sorted((r.id, r["text__y"]) for r in found.collect())
    for (i, a), (j, b) in zip(got, running_means(data, digits)):
        assert i == j and a == pytest.approx(b, abs=1e-9)


def test_many_categories_train_and_score(spark):
    """No limit: 5,000 categories, each with its own mean; unseen ones get the prior."""
    df = spark.range(20_000).select(
        "id", F.concat(F.lit("c"), F.col("id") % 5000).alias("text"), (F.col("id") % 5000 > 2500).cast("double").alias("y"))
    model = boosting.fit(df, ["text"], ["y"], replace(SETTINGS, iterations=2, learning_rate=1.0), ["id"])
    assert model.categories.count() == 5000
    error = boosting.score(model, df, ["id"]).join(df.withColumnRenamed("y", "t"), "id").agg(
        F.avg(F.abs(F.col("y") - F.col("t")))).first()[0]
    assert error < 0.1
    unseen = spark.createDataFrame([(1, "new"), (2, "c1")], "id long, text string")
    assert boosting.score(model, unseen, ["id"]).count() == 2
    table = category_table(df, ["text"], ["y"])
    met = with_statistics(unseen, table, ["text"], ["y"], {"y": 0.25}).orderBy("id").collect()
    assert met[0]["text__y"] == 0.25 and met[1]["text__y"] == pytest.approx(0.05)


def test_exponentials_are_computed_once_for_each_output(spark):
    """Seven classes: seven exponentials a row, not every one again for every output."""
    target = boosting.Target("kind", tuple(range(7)), (0.0,) * 7)
    scores = [[0.1 * k * (i + 1) for k in range(7)] for i in range(4)]
    wide = spark.createDataFrame(
        [([i], i, *s) for i, s in enumerate(scores)], "_bins array<int>, _y0 int, " + ", ".join(f"_s{k} double" for k in range(7)))
    found = boosting._with_gradients(wide, [target], {0: 1e9})
    assert found._jdf.queryExecution().optimizedPlan().toString().count("EXP(") == 7
    p = np.exp(scores) / np.exp(scores).sum(1, keepdims=True)
    for row in found.collect():
        i = row["_bins"][0]
        assert np.allclose([row[f"_g{k}"] for k in range(7)], 1e9 * ((np.arange(7) == i) - p[i]), atol=1)
        assert np.allclose([row[f"_h{k}"] for k in range(7)], 1e9 * p[i] * (1 - p[i]), atol=1)


def slices(monkeypatch, rows):
    """Blocks of about so many rows; the scale of the gradients stays that of one block."""
    monkeypatch.setattr(boosting, "_blocks", lambda data, model, made=boosting._blocks: made(data, model, rows))


@pytest.mark.parametrize("trees", [1, 8])
@pytest.mark.parametrize("targets", [("y", "z"), ("kind", "side")])
def test_blocks_change_nothing(table, monkeypatch, targets, trees):
    """Many blocks, a job for each level, scores stored in between: the trees of one block, to the last bit."""
    alone = boosting.fit(table, FEATURES, targets, SETTINGS, ("id",))
    slices(monkeypatch, 50)
    monkeypatch.setattr(boosting, "TREES_PER_STATE", trees)
    assert boosting.fit(table, FEATURES, targets, SETTINGS, ("id",)).trees == alone.trees


def test_slopes_equal_the_expressions(spark):
    """Gradients of a block in numpy and those of Spark's expressions."""
    scores, truth = np.array([[0.1 * k * (i + 1) for i in range(4)] for k in range(3)]), np.array([0.0, 2.0, 1.0, 2.0])
    target = boosting.Target("kind", (0, 1, 2), (0.0,) * 3)
    wide = spark.createDataFrame(
        [([i], int(y), *map(float, scores[:, i])) for i, y in enumerate(truth)], "_bins array<int>, _y0 int, _s0 double, _s1 double, _s2 double")
    g, h = boosting._slopes(target, truth, scores, 2.0**40)
    for row in boosting._with_gradients(wide, [target], {0: 2.0**40}).collect():
        i = row["_bins"][0]
        assert np.allclose(g[:, i], [row[f"_g{k}"] for k in range(3)], atol=1)
        assert np.allclose(h[:, i], [row[f"_h{k}"] for k in range(3)], atol=1)


def test_all_rounds_are_fitted_and_scored(table):
    """A thousand rounds at depth 6 on both targets; the fit comes near to the rows."""
    model = boosting.fit(table, FEATURES, ("y", "z"), key=("id",))
    assert [len(trees) for trees in model.trees] == [1000, 1000]
    assert {len(tree.levels) for trees in model.trees for tree in trees} == {6}
    found = boosting.score(model, table, ["id"]).orderBy("id").collect()
    assert np.abs(np.array([r.y for r in found]) - arrays(rows(), "y")[:, 0]).mean() < 0.1
