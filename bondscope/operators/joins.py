"""Equi-join that spreads hot keys over many tasks."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondscope.storage import settled

# A key is hot with more than this share of the rows, so there are at most
# 1 / HOT_SHARE hot keys, which bounds the broadcast below.
HOT_SHARE = 0.0005
HOT_ROWS = 1_000_000
# Ways for rows without a key in a left join.
NULL_WAYS = 64


def frequent_keys(
    df: DataFrame,
    keys: Sequence[Sequence[str]],
    share: float = HOT_SHARE,
    least: int = HOT_ROWS,
) -> list[DataFrame | None]:
    """For each list of key columns its hot keys with ``_ways``, or None without one.

    Hot is a key with more than ``share`` of the rows and more than ``least``; its ways are as
    many as leave no more rows than that to each. All lists share one pass over the key
    columns, which keeps a mergeable summary of 10 / share tracked hashes. That summary holds
    every hash with more than 0.53 * share of the rows, so only its keys are counted exactly, and keys are
    never all counted or shuffled. Rows with a null in the key do not count.
    """
    hashes = [F.xxhash64(*on) for on in keys]
    present = [reduce(and_, [F.col(c).isNotNull() for c in on]) for on in keys]
    top = [
        F.call_function("approx_top_k", F.when(there, h), F.lit(int(2 / share)), F.lit(int(10 / share)))
        for h, there in zip(hashes, present)
    ]
    columns = df.select(*dict.fromkeys(c for on in keys for c in on))
    total, *found = columns.agg(F.count("*"), *top).first()
    bound = max(total * share, least)
    hot = []
    for on, h, items in zip(keys, hashes, found):
        # Estimates are never below the true count.
        likely = [r["item"] for r in items if r["item"] is not None and r["count"] > bound]
        rows = None
        if likely:
            counts = columns.where(h.isin(likely)).groupBy(*on).agg(F.count("*").alias("_rows"))
            # Stored, so that both sides of a join see the same keys and ways.
            rows = settled(counts.where(F.col("_rows") > bound).select(
                *on, F.ceil(F.col("_rows") / bound).cast("int").alias("_ways")))
            rows = None if rows.isEmpty() else rows
        hot.append(rows)
    return hot


def join_spread(many: DataFrame, one: DataFrame, on: Sequence[str], hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """Inner or left join where the rows of ``many`` with a hot key are dealt over its ways.

    They are dealt by the input partition they come from, also when they are copies of each
    other, and the few matching rows of ``one`` are repeated per way. In a left join rows with
    a null key are dealt likewise. Without hot keys an inner join is a plain one.
    """
    on = list(on)
    if hot is None and how == "inner":
        return many.join(one, on)
    if hot is not None:
        many = many.join(F.broadcast(hot), on, "left")
        one = one.join(F.broadcast(hot), on, "left")
    else:
        many, one = (side.withColumn("_ways", F.lit(None).cast("int")) for side in (many, one))
    keyless = reduce(and_, [F.col(c).isNotNull() for c in on]) == F.lit(False)
    ways = F.when(keyless & F.lit(how == "left"), F.lit(NULL_WAYS)).otherwise(F.coalesce("_ways", F.lit(1)))
    left = many.withColumn("_way", F.pmod(F.spark_partition_id(), ways)).drop("_ways")
    every_way = F.sequence(F.lit(0), F.coalesce("_ways", F.lit(1)) - 1)
    right = one.withColumn("_way", F.explode(every_way)).drop("_ways")
    return left.join(right, [*on, "_way"], how).drop("_way")


def spread_join(
    many: DataFrame,
    one: DataFrame,
    on: Sequence[str],
    *,
    hot_share: float = HOT_SHARE,
    hot_rows: int = HOT_ROWS,
    how: str = "inner",
) -> DataFrame:
    """Join of ``many`` (keys may repeat without limit) to ``one`` (about one row per key).

    AQE splits a skewed side only when it comes straight from a shuffle; behind a pivot
    it does not. So the hot keys are found first, by a pass over the keys of ``many`` that
    runs now, and dealt over as many ways as their rows ask for.
    """
    hot, = frequent_keys(many, [on], hot_share, hot_rows)
    return join_spread(many, one, on, hot, how)
