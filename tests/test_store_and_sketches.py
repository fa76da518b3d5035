"""Laid-out tables without shuffles, and sketches within their rank error."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bondscope.operators import drift, sketches, wide
from bondscope.sources import store


@pytest.fixture(scope="module")
def motion(spark):
    return spark.range(3_000).select(
        F.concat(F.lit("u"), F.col("id")).alias("mapping_uid"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("date"),
        F.concat(F.lit("L"), F.col("id") % 3).alias("lot_id"), (F.col("id") % 97).cast("double").alias("heat_pre"))


@pytest.fixture(scope="module")
def qa(motion):
    items = F.array(*[F.struct(F.lit(i).alias("measure_item"), (F.col("heat_pre") * k).alias("value")) for i, k in (("a", 1), ("b", 2))])
    return motion.select("mapping_uid", "date", "lot_id", F.explode(items).alias("m")).select("mapping_uid", "date", "lot_id", "m.*")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lot_view_of_laid_out_tables_has_no_exchange(spark, motion, qa):
    names = "laid_out_motion", "laid_out_qa"
    try:
        for df, name in zip((motion, qa), names):
            store.save_laid_out(df, name, buckets=8)
        pairs = [("2024-01-02", "L1"), ("2024-01-04", "L0"), ("2024-01-02", "L1")]
        chosen = [store.chosen_lots(spark, name, pairs) for name in names]
        found = store.lot_view(chosen[1], chosen[0].drop("date", "lot_id"), ["a", "b"])
        plan = plan_of(found)
        assert "Exchange" not in plan and "Bucketed: true" in plan
        assert "PartitionFilters: [date#" in plan and "IN (2024-01-02,2024-01-04)" in plan.replace("2024-01-02, 2024-01-04", "2024-01-02,2024-01-04")
        wanted = F.expr("(date = '2024-01-02' AND lot_id = 'L1') OR (date = '2024-01-04' AND lot_id = 'L0')")
        plain = wide.lot_view(qa.where(wanted), motion.where(wanted).drop("date", "lot_id"), ["a", "b"])
        assert sorted(found.collect()) == sorted(plain.collect()) and found.count() > 100
        assert spark.table(names[0]).where("date = '2024-01-02'").count() == 600
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_merged_quantiles_keep_the_rank_error(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=60_000), np.full(30_000, 0.25), rng.exponential(size=30_000) * 5])
    days = rng.integers(0, 20, len(values))
    df = spark.createDataFrame([(int(d), "L", float(v), float("nan")) for d, v in zip(days, values)], "d int, lot_id string, x double, none double")
    df = df.withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), "d"))
    daily = sketches.daily_sketches(df, ["x", "none"])
    assert daily.count() == 40
    found = {r.column_name: r for r in sketches.quantiles(sketches.merged(daily), sketches.SHARES).collect()}
    assert found["none"].quantiles is None and found["none"].missing == len(values)
    ordered = np.sort(values)
    for share, x in zip(sketches.SHARES, found["x"].quantiles):
        low, high = (np.searchsorted(ordered, x, side) / len(values) for side in ("left", "right"))
        assert low - sketches.RANK_ERROR <= share <= high + sketches.RANK_ERROR
    assert (found["x"].n, found["x"].min, found["x"].max) == (len(values), values.min(), values.max())


def test_drift_from_sketches_is_near_the_exact_one(spark, motion):
    moved = motion.withColumn("heat_pre", F.col("heat_pre") * 1.2 + 3)
    sides = [sketches.merged(sketches.daily_sketches(df, ["heat_pre"])) for df in (motion, moved)]
    found = sketches.drift(*sides).first()
    exact = drift.column_drift(motion, moved, ["heat_pre"]).first()
    assert found.normed_distance == pytest.approx(exact.normed_distance, rel=0.03) and found.drifted == exact.drifted
    same = sketches.drift(sides[0], sides[0]).first()
    assert same.normed_distance < 0.01 and not same.drifted  # merging draws at random


def test_only_new_days_are_read(spark, motion):
    known = sketches.daily_sketches(motion.where("date < '2024-01-04'"), ["heat_pre"])
    left = sketches.new_days(motion, known)
    assert {str(r[0]) for r in left.select("date").distinct().collect()} == {"2024-01-04", "2024-01-05"}
    whole = known.unionByName(sketches.daily_sketches(left, ["heat_pre"]))
    assert sketches.merged(whole).first().n == 3_000
    assert sketches.daily_sketches(motion.limit(0), ["heat_pre"]).count() == 0
