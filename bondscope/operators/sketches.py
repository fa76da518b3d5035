"""Quantile sketches of each day, lot and column, stored once and merged for any period.

A reference period is read anew for each report otherwise. Sketches are KLL sketches of
Spark's own functions; merging them costs no scan of the rows.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondscope import names
from bondscope.operators.ranks import long_form

# Size of a sketch: its rank error is about 1.33 % at 200 and falls nearly as 1 / K.
K = 800
# Rank error that results of sketches with this K keep, also after merging.
RANK_ERROR = 0.005
SHARES = tuple(i / 100 for i in range(1, 100))


def daily_sketches(
    df: DataFrame,
    columns: Sequence[str],
    date: str = names.DATE,
    lot: str = names.LOT,
    k: int = K,
) -> DataFrame:
    """One row for each day, lot and column: rows, missing, sum, sum of squares, min, max, sketch.

    Partial sketches are merged after the shuffle, so a lot with a third of all rows costs
    one sketch a task.
    """
    cells = long_form(df, columns, [F.col(date).cast("date").alias("date"), F.col(lot).cast("string").alias("lot_id")])
    return cells.groupBy("date", "lot_id", "feature").agg(
        F.count("x").alias("n"), F.count_if(F.col("x").isNull()).alias("missing"), F.sum("x").alias("total"),
        F.sum(F.col("x") * F.col("x")).alias("squares"), F.min("x").alias("min"), F.max("x").alias("max"),
        F.call_function("kll_sketch_agg_double", "x", F.lit(k)).alias("sketch"),
    ).withColumn("column_name", F.get(F.array(*[F.lit(c) for c in columns]), "feature")).drop("feature")


def new_days(df: DataFrame, known: DataFrame, date: str = names.DATE) -> DataFrame:
    """Rows of the days that ``known`` has no sketches of; the days are few and reach the scan."""
    days = [r[0] for r in known.select("date").distinct().collect()]  # one for each day
    return df.where(~F.col(date).cast("date").isin(days)) if days else df


def merged(sketches: DataFrame, by: Sequence[str] = ("column_name",)) -> DataFrame:
    """Sketches of any choice of days and lots as one for each column."""
    return sketches.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("missing").alias("missing"), F.sum("total").alias("total"),
        F.sum("squares").alias("squares"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.call_function("kll_merge_agg_double", "sketch").alias("sketch"))


def quantiles(sketches: DataFrame, shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Columns with an array of quantiles, right to RANK_ERROR of the rows; null without values."""
    wanted = F.array(*[F.lit(float(s)) for s in shares])
    found = F.when(F.col("n") > 0, F.call_function("kll_sketch_get_quantile_double", "sketch", wanted))
    return sketches.withColumn("quantiles", found).drop("sketch")


def drift(reference: DataFrame, current: DataFrame, least: float = 0.1, smallest: float = 0.001) -> DataFrame:
    """Wasserstein distance of merged sketches for each column, over the reference's deviation.

    The distance is the mean gap of the quantiles at SHARES; it differs from the exact one by
    what lies beyond the outer shares and by the rank error.
    """
    deviation = F.sqrt(F.greatest(
        F.col("r.squares") / F.col("r.n") - F.pow(F.col("r.total") / F.col("r.n"), F.lit(2)), F.lit(0.0)))
    a, b = quantiles(reference, SHARES).alias("r"), quantiles(current, SHARES).alias("c")
    gaps = F.zip_with("r.quantiles", "c.quantiles", lambda x, y: F.abs(x - y))
    both = a.join(b, "column_name").select(
        "column_name", (F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x) / len(SHARES)).alias("distance"),
        F.greatest(deviation, F.lit(smallest)).alias("scale"))
    return both.select("column_name", "distance", (F.col("distance") / F.col("scale")).alias("normed_distance"),
                       (F.col("distance") / F.col("scale") >= least).alias("drifted"))
