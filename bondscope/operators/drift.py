"""Drift of numeric columns between a reference and a current frame."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondscope.operators.profile import column_moments
from bondscope.operators.ranks import chunked_form, chunker, feature_name, running_totals

# Smallest divisor of the distance, distance that counts as drift, share of
# drifted columns that makes the data set drifted.
SMALLEST_STD = 0.001
DRIFT_DISTANCE = 0.1
DRIFT_SHARE = 0.5

REPORT_SCHEMA = (
    "column_name string, distance double, normed_distance double, threshold double, drifted boolean"
)


def column_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    threshold: float = DRIFT_DISTANCE,
    smallest_std: float = SMALLEST_STD,
    chunks: int | None = None,
) -> DataFrame:
    """One row per column: Wasserstein distance, also divided by the reference's deviation.

    The distance is the area between both distribution functions, summed over the distinct
    values of both sides. Without reference rows the report is empty.
    """
    columns = list(columns)
    absent = [c for c in columns if c not in current.columns]
    if absent:
        raise ValueError(f"columns missing from the current data: {absent}")
    if reference.isEmpty():
        return reference.sparkSession.createDataFrame([], REPORT_SCHEMA)
    both = reference.select(F.lit(1).alias("side"), *columns).unionByName(
        current.select(F.lit(0).alias("side"), *columns)
    )
    counts = (
        chunked_form(both, columns, ["side"], chunker(both, columns, chunks))
        .groupBy("feature", "chunk", "x")
        .agg(F.sum("side").alias("ref"), F.sum(1 - F.col("side")).alias("cur"))
    )
    share = {
        s: F.try_divide(F.col(f"{s}_le").cast("double"), F.col(f"{s}_total").cast("double"))
        for s in ("ref", "cur")
    }
    area = F.abs(share["ref"] - share["cur"]) * (F.col("next_x") - F.col("x"))
    # The largest value has no next one and adds 0; without values on a side there is no distance.
    last = F.col("next_x").isNull() & share["ref"].isNotNull() & share["cur"].isNotNull()
    distances = (
        running_totals(counts, ["ref", "cur"])
        .groupBy("feature")
        .agg(F.sum(F.when(last, F.lit(0.0)).otherwise(area)).alias("distance"))
    )
    normed = F.col("distance") / F.greatest("std_pop", F.lit(smallest_std))
    return (
        column_moments(reference, columns)
        .select("feature", "std_pop")
        .join(distances, "feature", "left")
        .select(
            feature_name(columns).alias("column_name"),
            "distance",
            normed.alias("normed_distance"),
            F.lit(threshold).alias("threshold"),
            (normed >= threshold).alias("drifted"),
        )
    )


def dataset_drift(columns_report: DataFrame, share: float = DRIFT_SHARE) -> DataFrame:
    """One row: columns, drifted columns and their share, and whether the data set drifted."""
    report = columns_report.agg(
        F.count("*").alias("column_count"),
        F.count_if("drifted").alias("drifted_columns"),
    )
    drifted = F.try_divide("drifted_columns", "column_count")
    return report.withColumn("drifted_share", drifted).withColumn(
        "dataset_drifted", F.col("drifted_share") >= share
    )
