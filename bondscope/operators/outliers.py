"""Outlier rows by empirical cumulative distributions (ECOD).

Li, Zhao, Hu, Botta, Ionescu, Chen: ECOD: Unsupervised Outlier Detection Using Empirical
Cumulative Distribution Functions, 2022.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondscope import names
from bondscope.functions.columns import complete_rows
from bondscope.operators.profile import column_moments
from bondscope.operators.ranks import chunker, exact_quantile, long_form, number, ranked_values
from bondscope.storage import settled

# Fixed value: expected share of outlier rows.
CONTAMINATION = 0.001
# A value is frequent with at least 1 / FREQUENT of the rows, so the broadcast table of
# frequent values has at most columns x FREQUENT rows.
FREQUENT = 1_000
# Tails are added as whole numbers of this fraction. Sums of doubles depend on the order of
# addition, so equal rows could get different scores, and a retry another outlier.
FRACTION = 1e12
# Up to this many flagged rows are broadcast to pick the raw rows; more are joined by shuffle.
FEW_FLAGGED = 500_000
ROW = "_row"


def standardised(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace columns by (x - mean) / population standard deviation; a constant one becomes 0."""
    # One row of two numbers per column comes to the driver, whatever the number of rows.
    stats = column_moments(df, columns).select("feature", "mean", "std_pop").collect()
    scaled = {}
    for row in stats:
        column = columns[row["feature"]]
        scaled[column] = (number(column) - F.lit(row["mean"])) / F.lit(row["std_pop"] or 1.0)
    return df.withColumns(scaled)


def _with_row(df: DataFrame, columns: Sequence[str], na: str) -> DataFrame:
    """Add a fingerprint of the numeric values, so that rows sharing a key stay apart."""
    if na not in ("raise", "drop"):
        raise ValueError("na must be 'raise' or 'drop'")
    rows = complete_rows(df, columns) if na == "drop" else df
    return rows.withColumn(ROW, F.xxhash64(*columns))


def outlier_scores(
    df: DataFrame,
    columns: Sequence[str],
    key: Sequence[str] = (names.KEY,),
    combine: str = "feature",
    na: str = "raise",
    chunks: int | None = None,
) -> DataFrame:
    """ECOD score of every row: key columns, row fingerprint, score, copies.

    ``combine="feature"`` takes the largest tail of each column and adds the columns, as
    the PyOD implementation does (both tails where the skewness is exactly 0);
    ``combine="row"`` adds each tail over the columns and takes the largest sum, as in the
    paper. Equal rows appear once, with the number of their ``copies``.
    """
    if combine not in ("feature", "row"):
        raise ValueError("combine must be 'feature' or 'row'")
    rows = _with_row(df, columns, na).select(*key, ROW, *columns)
    cuts = chunker(rows, columns, chunks)
    sign = column_moments(rows, columns).select("feature", F.signum("skewness").alias("sign"))
    left = -F.log(F.col("n_le") / F.col("n_total"))
    right = -F.log((F.col("n_total") - F.col("n_le") + F.col("n")) / F.col("n_total"))
    if combine == "feature":
        both = F.when(F.col("sign") == 0, left + right).otherwise(F.lit(0.0))
        tails = {"best": F.greatest(left, right, both)}
    else:
        tails = {"left": left, "right": right, "auto": F.when(F.col("sign") < 0, left).otherwise(right)}
    weights = (
        ranked_values(rows, columns, cuts)
        .join(F.broadcast(sign), "feature")  # one row per column
        .select(
            "feature",
            "x",
            (F.col("n") * FREQUENT >= F.col("n_total")).alias("frequent"),
            *[F.round(tail * FRACTION).cast("long").alias(name) for name, tail in tails.items()],
        )
        .persist()
    )
    # Frequent values take their weights from a bounded broadcast: a value that fills a
    # third of a column never meets in one task, and the columns of a row are added up
    # before the shuffle. Only rare values go through the shuffled join.
    on = ["feature", "x"]
    missing = F.raise_error(F.lit("a numeric column has a missing value; pass na='drop'"))
    cells = long_form(rows, columns, [*key, ROW]).withColumn("x", F.coalesce("x", missing))
    frequent = weights.where("frequent").drop("frequent")
    rare = weights.where("not frequent").drop("frequent")
    near = cells.join(F.broadcast(frequent), on)
    far = cells.join(F.broadcast(frequent.select(*on)), on, "left_anti").join(rare, on)
    # Equal rows fall into one group; its cells are their number times the columns.
    copies = F.count("*") / F.lit(len(columns))
    sums = near.unionByName(far).groupBy(*key, ROW).agg(
        *[(F.sum(t) / copies).alias(t) for t in tails], copies.cast("long").alias("copies"))
    total = F.col("best") if combine == "feature" else F.greatest("left", "right", "auto")
    scores = settled(sums.select(*key, ROW, (total / FRACTION).alias("score"), "copies"))
    weights.unpersist()
    return scores


def outlier_threshold(
    scores: DataFrame,
    contamination: float = CONTAMINATION,
    exact: bool = True,
    chunks: int | None = None,
) -> DataFrame:
    """One row ``threshold``: the score quantile above which the expected share of rows lies.

    Copies of a row count each for itself.
    ``exact=False`` uses the approximate percentile, cheaper on very large data.
    """
    if exact:
        weight = "copies" if "copies" in scores.columns else None
        quantile = exact_quantile(scores, "score", 1 - contamination, chunks, weight)
        return quantile.withColumnRenamed("quantile", "threshold")
    return scores.agg(F.percentile_approx("score", 1 - contamination, 10_000).alias("threshold"))


def flagged(scores: DataFrame, threshold: DataFrame) -> DataFrame:
    """Add ``outlier``: whether the score lies above the threshold."""
    return scores.withColumn("outlier", F.col("score") > threshold.scalar())


def outliers(
    df: DataFrame,
    columns: Sequence[str],
    key: Sequence[str] = (names.KEY,),
    contamination: float = CONTAMINATION,
    combine: str = "feature",
    na: str = "raise",
    exact: bool = True,
    chunks: int | None = None,
) -> DataFrame:
    """The outlier rows of the frame, unscaled, with all their columns."""
    columns = list(columns)
    scores = outlier_scores(df, columns, key, combine, na, chunks)
    marks = flagged(scores, outlier_threshold(scores, contamination, exact, chunks)).where("outlier")
    marks = marks.select(*[F.col(c).alias(f"_mark_{i}") for i, c in enumerate([*key, ROW])])
    if marks.count() <= FEW_FLAGGED:
        marks = F.broadcast(marks)
    rows = _with_row(df, columns, na)
    match = F.lit(True)
    for i, c in enumerate([*key, ROW]):
        match = match & F.col(c).eqNullSafe(F.col(f"_mark_{i}"))
    return rows.join(marks, match, "left_semi").drop(ROW)
