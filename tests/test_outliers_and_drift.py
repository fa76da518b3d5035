import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bondscope import names
from bondscope.operators import drift, outliers, profile

FEW = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SAMPLE = st.lists(st.integers(-9, 9).map(float), min_size=2, max_size=30)


def frame(spark, **columns):
    return spark.createDataFrame(pd.DataFrame(columns))


def ecod(values: np.ndarray, combine: str) -> np.ndarray:
    """Brute force over all pairs of rows."""
    left = -np.log((values[None, :, :] <= values[:, None, :]).mean(axis=1))
    right = -np.log((values[None, :, :] >= values[:, None, :]).mean(axis=1))
    centred = values - values.mean(axis=0)
    third = (centred**3).mean(axis=0)
    sign = np.where(np.abs(third) < 1e-12, 0, np.sign(third))
    if combine == "feature":
        both = np.where(sign == 0, left + right, 0)
        both[:, values.std(axis=0) == 0] = 0
        return np.maximum(np.maximum(left, right), both).sum(axis=1)
    auto = np.where(sign < 0, left, right).sum(axis=1)
    return np.maximum(np.maximum(left.sum(axis=1), right.sum(axis=1)), auto)


@pytest.mark.parametrize("combine", ["feature", "row"])
@pytest.mark.parametrize("chunks", [1, 6])
@pytest.mark.parametrize("frequent", [1_000, 10])
def test_scores_by_brute_force(spark, monkeypatch, combine, chunks, frequent):
    monkeypatch.setattr(outliers, "FREQUENT", frequent)
    random = np.random.default_rng(3)
    values = np.column_stack([
        random.exponential(size=300),
        -random.exponential(size=300).round(1),
        np.where(random.random(300) < 0.4, 0.0, random.normal(size=300)),
        np.full(300, 2.5),
    ])
    df = frame(spark, key=range(300), **{f"c{i}": values[:, i] for i in range(4)})
    scores = outliers.outlier_scores(df, [f"c{i}" for i in range(4)], ["key"], combine, chunks=chunks)
    found = scores.orderBy("key").toPandas().score.to_numpy()
    assert found == pytest.approx(ecod(values, combine), abs=1e-9)


def test_scores_of_copies_and_shared_keys(spark):
    """A third of the rows are copies, and all rows share one key."""
    values = np.array([[1.0, 5.0]] * 10 + [[float(i), float(i * i % 7)] for i in range(20)])
    df = frame(spark, key=["same"] * 30, a=values[:, 0], b=values[:, 1])
    scores = outliers.outlier_scores(df, ["a", "b"], ["key"])
    joined = outliers._with_row(df, ["a", "b"], "raise").join(scores, ["key", outliers.ROW])
    found = {(r.a, r.b): r.score for r in joined.collect()}
    wanted = {tuple(v): s for v, s in zip(values, ecod(values, "feature"))}
    assert joined.count() == 30 and found == pytest.approx(wanted, abs=1e-9)


def test_outliers_return_raw_rows_with_all_columns(spark):
    df = frame(spark, key=range(100), a=[*map(float, range(99)), 1e6], b=[0.0] * 99 + [9.0], note=["x"] * 100)
    found = outliers.outliers(df, ["a", "b"], ["key"], contamination=0.01)
    assert found.columns == df.columns
    assert [(r.key, r.a) for r in found.collect()] == [(99, 1e6)]


def test_missing_values_raise_or_drop(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan")), (4, 2.0)], "key int, a double")
    with pytest.raises(Exception, match="missing value"):
        outliers.outlier_scores(df, ["a"], ["key"]).collect()
    kept = outliers.outlier_scores(df, ["a"], ["key"], na="drop")
    assert sorted(r.key for r in kept.collect()) == [1, 4]


def test_standardised_constant_column(spark):
    df = frame(spark, a=[1.0, 3.0], b=[5.0, 5.0])
    rows = outliers.standardised(df, ["a", "b"]).collect()
    assert sorted((r.a, r.b) for r in rows) == [(-1.0, 0.0), (1.0, 0.0)]


def test_approximate_threshold(spark):
    scores = spark.range(1_000).select(F.col("id").cast("double").alias("score"))
    assert outliers.outlier_threshold(scores, 0.01, exact=False).first()[0] == pytest.approx(989, abs=2)
    assert outliers.outlier_threshold(scores, 0.01).first()[0] == pytest.approx(989.01)


def wasserstein(a, b) -> float:
    points = np.unique(np.concatenate([a, b]))
    below = [(np.sort(x)[None, :] <= points[:, None]).mean(axis=1) for x in (a, b)]
    return float((np.abs(below[0] - below[1])[:-1] * np.diff(points)).sum())


def distance(spark, a, b, chunks=None):
    report = drift.column_drift(frame(spark, c=a), frame(spark, c=b), ["c"], chunks=chunks)
    return report.first()


@FEW
@given(a=SAMPLE, b=SAMPLE, chunks=st.sampled_from([1, 5]))
def test_wasserstein(spark, a, b, chunks):
    row = distance(spark, a, b, chunks)
    assert row.distance == pytest.approx(wasserstein(np.array(a), np.array(b)))
    assert row.normed_distance == pytest.approx(row.distance / max(np.std(a), 0.001))
    assert row.distance == pytest.approx(distance(spark, b, a).distance)


def test_distance_to_itself_and_to_a_shift(spark):
    a = [1.0, 2.0, 2.0, 7.0]
    assert distance(spark, a, a).distance == 0
    assert distance(spark, a, [x + 3 for x in a]).distance == pytest.approx(3)
    assert distance(spark, [4.0, 4.0], [4.0]).distance == 0


def test_empty_reference_gives_an_empty_report(spark):
    current = frame(spark, c=[1.0])
    report = drift.column_drift(current.where("c > 9"), current, ["c"])
    assert report.count() == 0
    assert report.columns == drift.column_drift(current, current, ["c"]).columns
    summary = drift.dataset_drift(report).first()
    assert summary.column_count == 0 and summary.drifted_share is None


def test_a_side_without_values_has_no_distance(spark):
    reference = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    current = spark.createDataFrame([(None, None)], "a double, b double")
    rows = drift.column_drift(reference, current, ["a", "b"]).collect()
    assert [r.distance for r in rows] == [None, None] and len(rows) == 2


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="missing from the current"):
        drift.column_drift(frame(spark, a=[1.0], b=[1.0]), frame(spark, a=[1.0]), ["a", "b"])


@pytest.mark.parametrize("chunks", [1, 4])
def test_profile(spark, chunks):
    rows = [(1.0,), (2.0,), (2.0,), (4.0,), (None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "a double").withColumn("empty", F.lit(None).cast("double"))
    a, empty = profile.column_profile(df, ["a", "empty"], chunks).orderBy("column_name").collect()
    assert (a.value_count, a.missing_count, a.distinct_count) == (4, 2, 3)
    assert (a.min, a.q25, a.median, a.q75, a.max) == (1.0, 1.75, 2.0, 2.5, 4.0)
    assert (a.most_common, a.most_common_share) == (2.0, pytest.approx(2 / 6))
    assert (empty.value_count, empty.missing_count, empty.distinct_count, empty.median) == (0, 6, 0, None)


def test_dataset_summary(spark):
    df = spark.createDataFrame([(1, "a", None), (1, None, float("nan")), (1, "b", 2.0)], "k int, t string, x double")
    assert tuple(profile.dataset_summary(df).first()) == (3, 3, 3, 2, 2)


@pytest.mark.parametrize("sensors, chunks", [(168, 1), (30, 3)])
def test_many_sensors(spark, sensors, chunks):
    """The full sensor list must not make planning explode; more than one group of columns."""
    columns = names.SENSORS[:sensors]
    values = np.random.default_rng(5).normal(size=(60, sensors)).round(1)
    df = frame(spark, mapping_uid=range(60), **dict(zip(columns, values.T)))
    scores = outliers.outlier_scores(df, columns, chunks=chunks)
    found = scores.orderBy("mapping_uid").toPandas().score.to_numpy()
    assert found == pytest.approx(ecod(values, "feature"), abs=1e-8)
    report = drift.column_drift(df, df.where("mapping_uid < 40"), columns, chunks=chunks)
    assert report.count() == sensors
