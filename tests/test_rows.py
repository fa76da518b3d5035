"""Choosing rows, widening, joins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bondscope.operators import lots, wide
from bondscope.operators.joins import frequent_keys, spread_join

DAY = dt.date(2024, 1, 1)


@pytest.fixture
def table(spark):
    rows = [("a", DAY, "L1"), ("b", DAY, "L1"), ("c", dt.date(2024, 1, 2), "L2"), ("d", DAY, "L2")]
    return spark.createDataFrame(rows, "mapping_uid string, date date, lot_id string")


def uids(df):
    return sorted(r.mapping_uid for r in df.collect())


def test_one_lot(table):
    assert uids(lots.lot(table, "2024-01-01", "L1")) == ["a", "b"]


def test_repeated_pair_repeats_rows(table):
    pairs = lots.lot_pairs(["2024-01-01", "2024-01-01"], ["L1", "L1"])
    assert uids(lots.lots(table, pairs)) == ["a", "a", "b", "b"]


def test_longer_list_is_cut_and_a_scalar_is_a_list():
    assert lots.lot_pairs(["d1", "d2", "d3"], ["l1"]) == [("d1", "l1")]
    assert lots.lot_pairs("d1", "l1") == [("d1", "l1")]


def test_lots_keep_the_columns(table):
    assert lots.lots(table, [("2024-01-02", "L2")]).columns == table.columns


def test_before_the_earliest_date(table):
    assert uids(lots.before(table, ["2024-01-05", "2024-01-02"])) == ["a", "b", "d"]


def test_date_filters_reach_the_scan(spark, table, tmp_path, capsys):
    table.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    lots.lots(stored, [("2024-01-01", "L1")]).explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters" in plan and "EqualTo(date,2024-01-01)" in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "long"])
@pytest.mark.parametrize("n", [1, 2, 5, 6, 99])
def test_newest_in_both_ways(spark, kind, n):
    days = [3, 1, 2, 3, 3, 2, 2]
    rows = spark.createDataFrame([(f"u{i}", f"2024-01-0{d}", d) for i, d in enumerate(days)], "k string, t string, d int")
    order = F.col("d").cast("long") if kind == "long" else F.col("t").cast(kind)
    df = rows.withColumn("t", order)
    wanted = sorted(range(7), key=lambda i: (-days[i], i))[:n]
    for chunks in (None, 1, 3):
        found = lots.newest(df, n, "t", ["k"], chunks=chunks)
        assert sorted(r.k for r in found.collect()) == sorted(f"u{i}" for i in wanted)


def test_newest_takes_rows_without_time_last(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("c", None)], "k string, t long")
    found = lots.newest(df, 2, "t", ["k"], chunks=1)
    assert sorted(r.k for r in found.collect()) == ["a", "b"]


def test_first_rows(table):
    assert uids(lots.first_rows(table, n=2)) == ["a", "b"]
    assert lots.first_rows(table).count() == 4


def test_widen_null_and_order(spark):
    qa = spark.createDataFrame(
        [("u", "x", 5.0, 2), ("u", "x", None, 1), ("u", "y", 7.0, 3), ("v", "z", 1.0, 1)],
        "mapping_uid string, measure_item string, value double, at int",
    )
    first = wide.widen(qa, ["x", "y"], order=["at"]).orderBy("mapping_uid").collect()
    assert [tuple(r) for r in first] == [("u", None, 7.0), ("v", None, None)]
    for order in (["at"], ["at", "value"]):
        filled = wide.widen(qa, ["x", "y"], order=order, ignore_nulls=True).orderBy("mapping_uid").first()
        assert tuple(filled) == ("u", 5.0, 7.0)


def test_widen_is_one_hash_aggregate(spark, capsys):
    qa = spark.createDataFrame([("u", "x", 5.0, 2)], "mapping_uid string, measure_item string, value double, at int")
    wide.widen(qa, ["x", "y"], order=["at"]).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and "SortAggregate" not in plan


@pytest.mark.parametrize("repartition", [1, 5])
def test_spread_join_with_a_hot_key(spark, repartition):
    many = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    many = many.unionByName(many.where("k = 0")).repartition(repartition)  # copies too
    one = spark.range(2_500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    plain = many.join(one, "k").orderBy("k", "v").collect()
    spread = spread_join(many, one, ["k"], hot_share=0.1, hot_rows=10)
    assert spread.orderBy("k", "v").collect() == plain


def test_hot_keys_come_from_a_summary(spark):
    # 1 / 150 of the rows, in copies, beside 60,000 keys of one row each; and keys of two columns and types.
    rows = spark.range(60_000).select(F.col("id").alias("k")).unionByName(
        spark.range(400).select(F.lit(-1).cast("long").alias("k")))
    rows = rows.select("k", F.col("k").cast("string").alias("t"), F.when(F.col("k") % 2 == 0, F.col("k")).alias("half"))
    one, two, none, nulls = frequent_keys(rows, [["k"], ["t", "k"], ["half", "t"], ["half"]], share=0.001, least=100)
    assert [tuple(r) for r in one.collect()] == [(-1, 4)]  # 400 rows, at most 100 to a way
    assert [tuple(r) for r in two.collect()] == [("-1", -1, 4)]
    assert none is None and nulls is None


def test_join_without_hot_keys_is_a_plain_join(spark, capsys):
    many, one = spark.range(1_000).withColumn("v", F.lit(1)), spark.range(10).withColumn("w", F.lit(2))
    spread_join(many, one, ["id"]).explain()
    plan = capsys.readouterr().out
    assert "Generate" not in plan and "Aggregate" not in plan


def test_left_spread_join_keeps_unmatched_and_null_keys(spark):
    many = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.col("id")).alias("k"), F.col("id").alias("v"))
    one = spark.range(5, 2_500).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("w"))
    plain = many.join(one, "k", "left").select("k", "v", "w").orderBy("v").collect()
    for rows in (10, 10_000):
        spread = spread_join(many, one, ["k"], hot_share=0.1, hot_rows=rows, how="left")
        assert spread.select("k", "v", "w").orderBy("v").collect() == plain


def test_truth_repeats_with_the_motion_key(spark):
    qa = spark.createDataFrame([("u", "x", 1.0), ("w", "x", 2.0)], "mapping_uid string, measure_item string, value double")
    motion = spark.createDataFrame([("u",), ("u",), ("v",)], "mapping_uid string")
    assert [tuple(r) for r in wide.ground_truth(qa, motion, ["x"]).collect()] == [("u", 1.0)] * 2
    once = wide.ground_truth(qa, motion, ["x"], repeat_keys=False)
    assert [tuple(r) for r in once.collect()] == [("u", 1.0)]
