import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bondscope.operators.ranks import chunker, exact_quantile, number, ranked_values

FEW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
NUMBERS = st.lists(st.integers(-20, 20).map(float), min_size=1, max_size=40)


def frame(spark, **columns):
    return spark.createDataFrame(pd.DataFrame(columns))


@pytest.mark.parametrize("chunks", [1, 2, 7, 50])
def test_ranks_do_not_depend_on_chunks(spark, monkeypatch, chunks):
    monkeypatch.setattr("bondscope.operators.ranks.COLUMNS_AT_ONCE", 1 if chunks == 7 else 24)
    random = np.random.default_rng(1)
    a = random.normal(size=500).round(2)
    b = np.where(random.random(500) < 0.4, 0.0, random.exponential(size=500))
    df = frame(spark, a=a, b=b)
    found = ranked_values(df, ["a", "b"], chunker(df, ["a", "b"], chunks)).toPandas()
    for feature, values in enumerate((a, b)):
        mine = found[found.feature == feature].set_index("x").sort_index()
        distinct = np.unique(values)
        assert list(mine.index) == list(distinct)
        assert list(mine.n) == [(values == x).sum() for x in distinct]
        assert list(mine.n_le) == [(values <= x).sum() for x in distinct]
        assert set(mine.n_total) == {500}
        assert list(mine.next_x.iloc[:-1]) == list(distinct[1:])
        assert pd.isna(mine.next_x.iloc[-1])


def test_missing_and_infinite_values(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (float("inf"),), (float("-inf"),)], ["a"])
    for chunks in (1, 3):
        rows = ranked_values(df, ["a"], chunker(df, ["a"], chunks)).orderBy("x").collect()
        assert [r.x for r in rows] == [float("-inf"), 1.0, float("inf")]
        assert [r.n_le for r in rows] == [1, 2, 3]


@FEW
@given(values=NUMBERS, share=st.sampled_from([0.0, 0.1, 0.5, 0.9, 0.999, 1.0]), chunks=st.sampled_from([1, 4]))
def test_exact_quantile(spark, values, share, chunks):
    found = exact_quantile(frame(spark, a=values), "a", share, chunks).first()[0]
    assert found == pytest.approx(np.percentile(values, 100 * share))


def test_exact_quantile_of_many_rows(spark):
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).alias("a"))
    wanted = np.percentile(df.toPandas().a, 99.9)
    assert exact_quantile(df, "a", 0.999).first()[0] == pytest.approx(wanted)


def test_quantile_without_rows(spark):
    assert exact_quantile(spark.createDataFrame([], "a double"), "a", 0.5).first()[0] is None


def test_number(spark):
    df = spark.createDataFrame([(1,)], ["a"])
    assert df.select(number("a")).first()[0] == 1.0


def test_both_zeros_are_one_value(spark):
    df = frame(spark, a=[-1.0, -0.0, 0.0, -0.0, 0.0, 1.0])
    for chunks in (1, 2, 5):
        rows = ranked_values(df, ["a"], chunker(df, ["a"], chunks)).orderBy("x").collect()
        assert [(r.x, r.n) for r in rows] == [(-1.0, 1), (0.0, 4), (1.0, 1)]
