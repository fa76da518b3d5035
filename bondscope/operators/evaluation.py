"""Predictions against ground truth: alignment, error metrics, gate."""

import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bondscope import names
from bondscope.operators.joins import spread_join

METRICS = ("r2_score", "mse_score", "pos_max_err", "neg_max_err")
GATES = {"<=": operator.le, "<": operator.lt, ">": operator.gt, ">=": operator.ge}


def aligned(
    predictions: DataFrame,
    truth: DataFrame,
    targets: Sequence[str],
    key: Sequence[str] = (names.KEY,),
    prefix: str = "predicted_",
    **spread,
) -> DataFrame:
    """Each prediction beside the truth of its key: key, targets, prefixed predictions.

    Rows of truth with a missing target are left out. Equal repeats of a key are taken
    once, so repeats on both sides do not multiply; repeats that differ are an error.
    """
    conflict = F.raise_error(F.lit("ground truth has different values for one key"))
    once = (
        truth.select(*key, *targets)
        .na.drop(subset=list(targets))
        .groupBy(*key)
        .agg(*[F.when(F.min(t) == F.max(t), F.min(t)).otherwise(conflict).alias(t) for t in targets])
    )
    named = predictions.select(*key, *[F.col(t).alias(prefix + t) for t in targets])
    return spread_join(named, once, key, **spread).select(*key, *targets, *[prefix + t for t in targets])


def key_check(predictions: DataFrame, truth: DataFrame, key: Sequence[str] = (names.KEY,)) -> DataFrame:
    """One row: keys missing on either side, and whether the key sets are equal.

    A union and one aggregation: keys are combined before the shuffle, nothing is joined.
    """
    sides = predictions.select(*key, F.lit(1).alias("p"), F.lit(0).alias("t")).unionByName(
        truth.select(*key, F.lit(0).alias("p"), F.lit(1).alias("t"))
    )
    keys = sides.groupBy(*key).agg(F.max("p").alias("p"), F.max("t").alias("t"))
    return keys.agg(
        F.count_if(F.col("t") == 0).alias("missing_in_truth"),
        F.count_if(F.col("p") == 0).alias("missing_in_predictions"),
    ).withColumn("keys_match", (F.col("missing_in_truth") == 0) & (F.col("missing_in_predictions") == 0))


def _r2(truth: Column, predicted: Column) -> Column:
    squared_errors = F.sum(F.pow(truth - predicted, F.lit(2.0)))
    spread = F.var_pop(truth) * F.count(truth)
    constant = F.when(squared_errors == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    # A zero spread is a constant target. The division must not see it.
    return F.when(spread == 0, constant).otherwise(F.lit(1.0) - F.try_divide(squared_errors, spread))


def error_metrics(pairs: DataFrame, targets: Sequence[str], prefix: str = "predicted_") -> DataFrame:
    """One row: R2 and MSE averaged over the targets, extreme signed errors over all cells."""
    pairs = pairs.na.drop(subset=[*targets, *[prefix + t for t in targets]])
    columns = [(F.col(t).cast("double"), F.col(prefix + t).cast("double")) for t in targets]

    def mean(values: list[Column]) -> Column:
        total = values[0]
        for value in values[1:]:
            total = total + value
        return total / F.lit(float(len(values)))

    def extreme(pick, values: list[Column]) -> Column:
        return values[0] if len(values) == 1 else pick(*values)

    return pairs.agg(
        mean([_r2(y, p) for y, p in columns]).alias("r2_score"),
        mean([F.avg(F.pow(y - p, F.lit(2.0))) for y, p in columns]).alias("mse_score"),
        extreme(F.greatest, [F.max(p - y) for y, p in columns]).alias("pos_max_err"),
        extreme(F.least, [F.min(p - y) for y, p in columns]).alias("neg_max_err"),
    )


def gate(
    metrics: DataFrame,
    metric: str = "mse_score",
    limit: float = 50.0,
    keep_if: str = "<=",
) -> DataFrame:
    """Add ``accepted``: whether the model is good enough to keep.

    The workflow this replaces kept models with an error *above* the limit; pass
    ``keep_if=">"`` for that.
    """
    return metrics.withColumn("accepted", GATES[keep_if](F.col(metric), F.lit(limit)))


def shape(df: DataFrame) -> DataFrame:
    """One row: rows and columns of the frame."""
    return df.agg(F.count("*").alias("rows_fetched")).withColumn(
        "columns_fetched", F.lit(len(df.columns))
    )


def is_empty(df: DataFrame) -> bool:
    """Whether the frame has no row; stops at the first row found."""
    return df.isEmpty()


def empty_flag(df: DataFrame) -> DataFrame:
    """``is_empty`` as a one-row frame, without running a job now."""
    return df.limit(1).agg((F.count("*") == 0).alias("is_empty"))
