"""Ordered target statistics: text features as running means of the target.

Each row gets the mean of the target over the rows of its category that come before it in a
hash order, so that its own target never enters its feature. Rows to be scored get the mean over all
training rows. There is no limit on the number of categories: they stay in a table.
"""

from collections.abc import Mapping, Sequence
from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Weight of the mean over all rows in each category, in rows.
PRIOR_ROWS = 1.0
# Rows of one category that are sorted in one task.
ROWS_PER_CHUNK = 1_000_000


def hash_order(key: Sequence[str]) -> Column:
    """Text that orders rows in a repeatable, random way."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]))


def chunk_digits(rows: int, rows_per_chunk: int = ROWS_PER_CHUNK) -> int:
    """Leading hexadecimal digits that cut even one category with all rows into short chunks."""
    return 0 if rows <= rows_per_chunk else ceil(log(rows / rows_per_chunk, 16))


def priors(df: DataFrame, targets: Sequence[str]) -> dict[str, float]:
    """Mean of each target over all rows; 0 without rows."""
    found = df.agg(*[F.avg(t).alias(t) for t in targets]).first()
    return {t: found[t] or 0.0 for t in targets}


def smoothed(total: Column, rows: Column, prior: float) -> Column:
    return (F.coalesce(total, F.lit(0.0)) + F.lit(PRIOR_ROWS * prior)) / (F.coalesce(rows, F.lit(0)) + F.lit(PRIOR_ROWS))


def encoded_name(feature: str, target: str) -> str:
    return f"{feature}__{target}"


def ordered_statistics(
    df: DataFrame,
    features: Sequence[str],
    targets: Sequence[str],
    order: Column,
    prior: Mapping[str, float],
    digits: int | None = None,
) -> DataFrame:
    """Add a column ``<feature>__<target>`` for each pair.

    Sums are found on two levels: within chunks, which are the leading digits of the order, and over the
    chunks of a category. So a category with a third of all rows is sorted by many tasks.
    Rows of equal order (repeated keys) do not count for each other.
    """
    if digits is None:
        digits = chunk_digits(df.count())
    rows = df.withColumn("_order", order).withColumn("_chunk", F.substring("_order", 1, digits))
    for feature in features:
        chunk = [feature, "_chunk"]
        totals = rows.groupBy(*chunk).agg(
            F.count("*").alias("_rows"), *[F.sum(F.col(t).cast("double")).alias(f"_sum_{t}") for t in targets])
        earlier = Window.partitionBy(feature).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select(
            F.col(feature).alias("_category"), F.col("_chunk").alias("_chunk_of"),
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows"),
            *[F.coalesce(F.sum(f"_sum_{t}").over(earlier), F.lit(0.0)).alias(f"_sum_{t}") for t in targets])
        # Peers come with the current row of a range; the sum over them is taken out again.
        upto = Window.partitionBy(*chunk).orderBy("_order").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        peers = Window.partitionBy(*chunk).orderBy("_order").rangeBetween(Window.currentRow, Window.currentRow)
        within = rows.withColumns({
            "_n": F.count("*").over(upto) - F.count("*").over(peers),
            **{f"_in_{t}": F.sum(F.col(t).cast("double")).over(upto) - F.sum(F.col(t).cast("double")).over(peers)
               for t in targets}})
        same = within[feature].eqNullSafe(offsets["_category"]) & (within["_chunk"] == offsets["_chunk_of"])
        joined = within.join(offsets, same)
        rows = joined.select(
            *rows.columns,
            *[smoothed(F.col(f"_in_{t}") + F.col(f"_sum_{t}"), F.col("_n") + F.col("_rows"), prior[t]).alias(
                encoded_name(feature, t)) for t in targets])
    return rows.drop("_order", "_chunk")


def category_table(df: DataFrame, features: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """One row for each category of each feature: feature, category, rows and the sum of each target.

    Partial sums come first, so that a frequent category costs no more than a rare one.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("category")) for f in features]))
    long = df.select(pairs.alias("_pair"), *targets)
    return long.groupBy("_pair.feature", "_pair.category").agg(
        F.count("*").alias("rows"), *[F.sum(F.col(t).cast("double")).alias(f"sum_{t}") for t in targets])


def with_statistics(
    df: DataFrame,
    table: DataFrame,
    features: Sequence[str],
    targets: Sequence[str],
    prior: Mapping[str, float],
) -> DataFrame:
    """Add the columns of ``ordered_statistics`` from a category table; unseen categories get the prior.

    Spark broadcasts the table only while it is below its own size limit.
    """
    rows = df
    for feature in features:
        known = table.where(F.col("feature") == feature).select(
            F.col("category").alias("_category"), F.col("rows").alias("_rows"),
            *[F.col(f"sum_{t}").alias(f"_sum_{t}") for t in targets])
        joined = rows.join(known, rows[feature].eqNullSafe(known["_category"]), "left")
        rows = joined.select(*rows.columns, *[
            smoothed(F.col(f"_sum_{t}"), F.col("_rows"), prior[t]).alias(encoded_name(feature, t)) for t in targets])
    return rows
