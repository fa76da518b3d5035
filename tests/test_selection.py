"""Selection of the first rows against a full sort, through many passes."""

import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from bondscope.operators import lots, outliers, selection

MANY = 300


def values(kind, draw):
    pick = {
        "long": lambda: 2**60 + draw.randrange(20),
        "string": lambda: draw.choice(["", "a", "B", "é", "zz", "a b"]),
        "double": lambda: draw.choice([float("nan"), -0.0, 0.0, 1e300, draw.random()]),
        "decimal(30,4)": lambda: Decimal(draw.randrange(10**6)) / 100,
        "date": lambda: dt.date(2024, 1, 1) + dt.timedelta(draw.randrange(9)),
        "timestamp": lambda: dt.datetime(2024, 3, 31, draw.randrange(24), 0, 0, draw.randrange(3)),
        "timestamp_ntz": lambda: dt.datetime(2024, 3, 31, draw.randrange(24), 0, 0, draw.randrange(3)),
        "boolean": lambda: draw.random() < 0.5,
    }[kind]
    return [None if draw.random() < 0.05 else pick() for _ in range(MANY)]


@pytest.mark.parametrize("kind", ["long", "string", "double", "decimal(30,4)", "date", "timestamp", "timestamp_ntz", "boolean"])
def test_any_type_equals_a_full_sort(spark, monkeypatch, kind):
    monkeypatch.setattr(selection, "DRAWN_ROWS", 20)
    draw = random.Random(kind)
    keys = [(None if i % 50 == 0 else f"k{i % 90}", 2**60 + i % 7) for i in range(MANY)]
    df = spark.createDataFrame([(v, *k, i) for i, (v, k) in enumerate(zip(values(kind, draw), keys))],
                               f"first {kind}, a string, b long, other int").cache()
    whole = df.orderBy(F.desc_nulls_last("first"), F.asc_nulls_first("a"), "b", "other").collect()
    for n in (1, 37, 299, 300, 400, 0):
        found = selection.first_in_order(df, n, "first", ["a", "b"], most=10).collect()
        assert sorted(map(str, found)) == sorted(map(str, whole[:n]))


def test_both_sides_of_ten_thousand(spark):
    """Long order columns beyond 2^53 and rows without a unique key."""
    big = spark.range(20_000).select((F.lit(2**53) + F.col("id") * 2 + 1).alias("t"), F.lit("same").alias("k"))
    for n in (9_999, 10_000, 10_001, 11_000):
        found = lots.newest(big, n, "t", ["k"]).agg(F.count("*"), F.min("t")).first()
        assert tuple(found) == (n, 2**53 + (20_000 - n) * 2 + 1)
    equal = spark.range(20_000).select(F.lit(1).alias("t"), F.lit("same").alias("k"), "id")
    assert lots.newest(equal, 11_000, "t", ["k"]).agg(F.count("*"), F.max("id")).first() == (11_000, 10_999)


def test_the_filter_reaches_the_scan(spark, tmp_path):
    spark.range(5_000).select(F.col("id").alias("t"), (F.col("id") % 7).alias("k")).write.parquet(str(tmp_path / "x"))
    found = lots.newest(spark.read.parquet(str(tmp_path / "x")), 100, "t", ["k"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t," in plan and "Sort" not in plan


def test_threshold_counts_copies(spark):
    draw = random.Random(4)
    unique = [(f"u{i}", draw.gauss(0, 1), draw.gauss(0, 1)) for i in range(400)]
    rows = unique + unique[:7] * 60
    df = spark.createDataFrame(rows, "mapping_uid string, a double, b double")
    scores = outliers.outlier_scores(df, ["a", "b"])
    by_key = {r.mapping_uid: (r.score, r.copies) for r in scores.collect()}
    assert {k: c for k, (_, c) in by_key.items()} == {f"u{i}": 61 if i < 7 else 1 for i in range(400)}
    every = np.repeat([s for s, _ in by_key.values()], [c for _, c in by_key.values()])
    for share in (0.01, 0.1, 0.4):
        wanted = np.quantile(every, 1 - share)
        assert outliers.outlier_threshold(scores, share).first()[0] == pytest.approx(wanted)
        flagged = sum(by_key[k][0] > wanted for k, *_ in rows)
        assert outliers.outliers(df, ["a", "b"], contamination=share).count() == flagged
