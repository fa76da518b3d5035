"""Column and data set profiles."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondscope.operators.ranks import (
    chunker,
    feature_name,
    interpolated,
    long_form,
    quantile,
    ranked_values,
)


def listed_numeric(df: DataFrame, listed: Sequence[str]) -> list[str]:
    """The listed columns that the frame has, in the order of the list."""
    present = set(df.columns)
    return [c for c in listed if c in present]


def column_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows, values, infinite, mean, std (sample and population), skewness."""
    infinite = F.abs(F.col("x")) == float("inf")
    return (
        long_form(df, columns)
        .groupBy("feature")
        .agg(
            F.count("*").alias("rows"),
            F.count("x").alias("values"),
            F.count_if(infinite).alias("infinite"),
            F.avg("x").alias("mean"),
            F.stddev_samp("x").alias("std"),
            F.stddev_pop("x").alias("std_pop"),
            F.skewness("x").alias("skewness"),
        )
    )


def column_profile(df: DataFrame, columns: Sequence[str], chunks: int | None = None) -> DataFrame:
    """One row per numeric column: counts, moments, exact quantiles, most common value.

    Distinct values, quantiles and the most common value all come from one table of
    ranked values, instead of aggregates that hold a column's values in one task.
    """
    columns = list(columns)
    ranked = ranked_values(df, columns, chunker(df, columns, chunks))
    quartiles = {"q25": 0.25, "median": 0.5, "q75": 0.75}
    values = ranked.groupBy("feature").agg(
        F.count("*").alias("distinct"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
        # Most frequent first, then the smaller value.
        F.min(F.struct((-F.col("n")).alias("less"), "x")).alias("top"),
        *[F.struct(*quantile(share)).alias(name) for name, share in quartiles.items()],
    )
    missing = F.col("rows") - F.col("values")
    return (
        column_moments(df, columns)
        .join(values, "feature", "left")
        .select(
            feature_name(columns).alias("column_name"),
            F.col("values").alias("value_count"),
            missing.alias("missing_count"),
            (missing / F.col("rows")).alias("missing_share"),
            F.coalesce("distinct", F.lit(0)).alias("distinct_count"),
            (F.coalesce("distinct", F.lit(0)) / F.col("rows")).alias("distinct_share"),
            "mean",
            "std",
            "min",
            *[interpolated(F.col(q)).alias(q) for q in quartiles],
            "max",
            F.col("top.x").alias("most_common"),
            (-F.col("top.less") / F.col("rows")).alias("most_common_share"),
            F.col("infinite").alias("infinite_count"),
        )
    )


def profile_both(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    chunks: int | None = None,
) -> DataFrame:
    """Column profiles of both frames, told apart by ``side``."""
    sides = {"reference": reference, "current": current}
    profiles = [
        column_profile(df, columns, chunks).select(F.lit(side).alias("side"), "*")
        for side, df in sides.items()
    ]
    return profiles[0].unionByName(profiles[1])


def time_profile(df: DataFrame, column: str) -> DataFrame:
    """One row: earliest, latest and missing values of a timestamp column."""
    return df.agg(
        F.lit(column).alias("column_name"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
        F.count_if(F.col(column).isNull()).alias("missing_count"),
    )


def dataset_summary(df: DataFrame) -> DataFrame:
    """One row: rows, columns, missing cells, rows with a missing cell, constant columns."""

    def missing(c: str):
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            return F.col(c).isNull() | F.isnan(c)
        return F.col(c).isNull()

    flags = df.select("*", *[missing(c).alias(f"_missing_{i}") for i, c in enumerate(df.columns)])
    marks = [F.col(f"_missing_{i}") for i in range(len(df.columns))]
    cells = reduce(lambda a, b: a + b, [m.cast("long") for m in marks])
    filled = [F.when(~m, F.col(c)) for m, c in zip(marks, df.columns)]
    constant = [F.when(F.min(v) == F.max(v), 1).otherwise(0) for v in filled]
    return flags.agg(
        F.count("*").alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.coalesce(F.sum(cells), F.lit(0)).alias("missing_cells"),
        F.count_if(reduce(lambda a, b: a | b, marks)).alias("rows_with_missing"),
        reduce(lambda a, b: a + b, constant).alias("constant_columns"),
    )
