"""Dense ids of categories, sparse vectors, and a linear model on them."""

import random

import pytest
from pyspark.sql import functions as F

from bondscope.operators import dictionary
from bondscope.operators.dictionary import CategoryModel


def ids_of(table, feature):
    return {r.category: r.id for r in table.where(F.col("feature") == feature).collect()}


def test_ids_are_dense_and_in_order(spark):
    draw = random.Random(1)
    words = ["", " ", "a", "A", "é", "Z", "\U0001F600", "�"] + [f"w{i:05d}" for i in range(6_000)]
    data = [(draw.choice(words), draw.choice(["x", "y", None])) for _ in range(4_000)] + [("hot", "x")] * 4_000
    table = dictionary.dictionary(spark.createDataFrame(data, "t string, u string").repartition(7), ["t", "u"])
    for at, feature in enumerate("tu"):
        seen = sorted({r[at] for r in data if r[at] is not None}, key=lambda v: v.encode())
        assert ids_of(table, feature) == {v: i for i, v in enumerate(seen)}
    rows = {(r.feature, r.category): r.rows for r in table.collect()}
    assert rows["u", "x"] == sum(r[1] == "x" for r in data) and rows["t", "hot"] == 4_000


def test_empty_table_and_columns_of_nulls(spark):
    nothing = spark.createDataFrame([], "t string, u string")
    table = dictionary.dictionary(nothing, ["t", "u"])
    assert dictionary.dictionary_sizes(table, ["t", "u"]) == {"t": 0, "u": 0}
    later = spark.createDataFrame([("a", None)], "t string, u string")
    assert [tuple(r) for r in dictionary.encoded(later, table, {"t": 0, "u": 0}).collect()] == [(0, None)]
    vectors = dictionary.one_hot_vectors(later, table, {"t": 0, "u": 0}).first()
    assert vectors.t_vector.size == 1 and vectors.t_vector[0] == 1 and vectors.u_vector.numNonzeros() == 0


@pytest.mark.parametrize("hot_rows", [10, 1_000_000])
def test_unseen_values_share_a_place_and_null_has_none(spark, hot_rows):
    fitted = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "t string, n int")
    table = dictionary.dictionary(fitted, ["t"])
    sizes = dictionary.dictionary_sizes(table, ["t"])
    data = [(v, i) for i, v in enumerate(["a"] * 300 + ["new"] * 300 + [None] * 300 + ["c", "other", "b"])]
    later = spark.createDataFrame(data, "t string, n int").repartition(5)
    expected = {"a": 0, "b": 1, "c": 2, "new": 3, "other": 3, None: None}
    found = dictionary.encoded(later, table, sizes, hot_share=0.1, hot_rows=hot_rows)
    assert found.columns == ["t", "n"]
    assert sorted((r.n, r.t) for r in found.collect()) == [(i, expected[v]) for v, i in data]
    for row in dictionary.one_hot_vectors(later, table, sizes, hot_share=0.1, hot_rows=hot_rows).collect():
        place = expected[data[row.n][0]]
        assert row.t_vector.size == 4 and list(row.t_vector.indices) == ([] if place is None else [place])


def test_five_thousand_categories_are_fitted_saved_and_scored(spark, tmp_path):
    rows = spark.range(15_000).select(
        F.format_string("v%04d", F.col("id") % 5_000).alias("t"), F.when(F.col("id") % 4 > 0, "odd").alias("u"),
        (F.col("id") % 7).cast("double").alias("x")).withColumn(
        "y", F.length("t") + F.substring("t", 2, 4).cast("int") / 100 + 3 * F.col("x") + F.when(F.col("u") == "odd", 5).otherwise(0))
    model = dictionary.fit_categories(rows, ["t", "u"], ["x"], "y", tolerance=1e-10, iterations=200)
    assert model.sizes == {"t": 5_000, "u": 1}
    model.save(str(tmp_path / "model"))
    loaded = CategoryModel.load(spark, str(tmp_path / "model"))
    scored = loaded.score(rows)
    assert scored.columns == ["t", "u", "x", "y", "prediction"]
    assert scored.agg(F.max(F.abs(F.col("y") - F.col("prediction")))).first()[0] < 0.01
    later = loaded.score(spark.createDataFrame([("unseen", None, 1.0), (None, None, 1.0)], "t string, u string, x double")).collect()
    assert later[0].prediction == pytest.approx(later[1].prediction)  # neither has a weight
