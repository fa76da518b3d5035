"""Exact ranks of many numeric columns at once.

A window over one column would sort that whole column in one task. Here every column
is cut at approximate quantiles into chunks. The chunk of a value depends on the value
alone, so chunks are sorted and summed independently, and the sums of the earlier
chunks are added as offsets. The cut points only balance the work: ranks are exact
wherever they fall.

Columns travel as their position in the column list, which keeps shuffles narrow.
"""

from collections.abc import Sequence
from functools import reduce
from math import ceil, inf

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# One chunk is sorted in one task. The chunk table (columns x chunks rows) is broadcast,
# which MAX_CHUNKS bounds whatever the data size.
ROWS_PER_CHUNK = 100_000
MAX_CHUNKS = 4_000
COLUMNS_AT_ONCE = 24
# Rows per chunk that cut points are estimated from.
CUT_ROWS = 1_000


def number(column: str) -> Column:
    """The column as a double, with NaN as NULL: both mean "no measurement"."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def chunker(
    df: DataFrame,
    columns: Sequence[str],
    chunks: int | None = None,
) -> list[list[float]] | None:
    """Cut points of each column, or None when one chunk per column is enough.

    They are estimated from some of the rows, as range partitioning does: they decide how
    evenly the work is spread and nothing else. Every row is ranked, exactly.
    """
    rows = df.count()
    if chunks is None:
        chunks = min(MAX_CHUNKS, ceil(rows / ROWS_PER_CHUNK))
    if chunks <= 1:
        return None
    share_read = min(1.0, chunks * CUT_ROWS / max(rows, 1))
    shares = [i / chunks for i in range(1, chunks)]
    found = (
        long_form(df.sample(share_read, seed=0), columns)
        .where(F.abs("x") < inf)
        .groupBy("feature")
        .agg(F.percentile_approx("x", shares, 4 * chunks).alias("cuts"))
        .collect()  # at most len(columns) x MAX_CHUNKS numbers
    )
    cuts = {row["feature"]: sorted(set(row["cuts"])) for row in found}
    return [cuts.get(i, [0.0]) for i in range(len(columns))]


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str | Column] = ()) -> DataFrame:
    """One row per row and column: kept columns, feature (position), x. Keeps nulls.

    The numbers are gathered in one array column and cleaned after the explode. One alias
    per column instead makes planning and the generated code very slow with many columns.
    """
    arrays = df.select(*keep, F.array(*[F.col(c).cast("double") for c in columns]).alias("_xs"))
    kept = arrays.columns[:-1]
    cells = arrays.select(*kept, F.posexplode("_xs").alias("feature", "x"))
    return cells.withColumn("x", number("x"))


def chunked_form(
    df: DataFrame,
    columns: Sequence[str],
    keep: Sequence[str] = (),
    cuts: list[list[float]] | None = None,
) -> DataFrame:
    """Long form of the values that are not missing, with their chunk.

    With cut points the columns are handled in groups, which a columnar source reads
    separately, so every value is still read once.
    """
    if cuts is None:
        cells = long_form(df, columns, keep).withColumn("chunk", F.lit(0))
        return cells.where(F.col("x").isNotNull())
    parts = []
    for start in range(0, len(columns), COLUMNS_AT_ONCE):
        group = columns[start : start + COLUMNS_AT_ONCE]
        xs = [f"_x{i}" for i in range(len(group))]
        cs = [f"_c{i}" for i in range(len(group))]
        bucketizer = Bucketizer(
            inputCols=xs,
            outputCols=cs,
            splitsArray=[[-inf, *cuts[start + i], inf] for i in range(len(group))],
            handleInvalid="keep",
        )
        # Adding 0 turns -0.0 into 0.0, which the search among cut points would tell apart.
        values = [(F.col(c).cast("double") + F.lit(0.0)).alias(x) for c, x in zip(group, xs)]
        wide = df.select(*keep, *values)
        arrays = bucketizer.transform(wide).select(
            *keep,
            F.array(*xs).alias("x"),
            F.array(*[F.col(c).cast("int") for c in cs]).alias("chunk"),
        )
        cells = arrays.select(*keep, F.posexplode(F.arrays_zip("x", "chunk")).alias("place", "cell"))
        parts.append(
            cells.select(
                *keep,
                (F.col("place") + start).alias("feature"),
                F.col("cell.x").alias("x"),
                F.col("cell.chunk").alias("chunk"),
            ).where(F.col("x").isNotNull() & ~F.isnan("x"))
        )
    return reduce(DataFrame.unionAll, parts)


def feature_name(columns: Sequence[str], feature: str = "feature") -> Column:
    """Name of a column from its position in the list."""
    return F.element_at(F.array(*[F.lit(c) for c in columns]), F.col(feature) + 1)


def running_totals(counts: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Add, per feature in the order of x, running and whole sums of the measures.

    ``counts`` has one row per (feature, chunk, x). For each measure m the result has
    ``m_le`` (sum over values up to and including x) and ``m_total``; ``next_x`` is the
    next larger value of the feature.
    """
    by_chunk = Window.partitionBy("feature").orderBy("chunk")
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.groupBy("feature", "chunk")
        .agg(F.min("x").alias("first_x"), *[F.sum(m).alias(m) for m in measures])
        .select(
            "feature",
            "chunk",
            F.lead("first_x").over(by_chunk).alias("next_first_x"),
            *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"{m}_before") for m in measures],
            *[F.sum(m).over(Window.partitionBy("feature")).alias(f"{m}_total") for m in measures],
        )
    )
    inside = Window.partitionBy("feature", "chunk").orderBy("x")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # offsets: at most len(columns) x MAX_CHUNKS rows.
    return counts.join(F.broadcast(offsets), ["feature", "chunk"]).select(
        "feature",
        "chunk",
        "x",
        *measures,
        *[(F.col(f"{m}_before") + F.sum(m).over(so_far)).alias(f"{m}_le") for m in measures],
        *[f"{m}_total" for m in measures],
        F.coalesce(F.lead("x").over(inside), F.col("next_first_x")).alias("next_x"),
    )


def ranked_values(
    df: DataFrame,
    columns: Sequence[str],
    cuts: list[list[float]] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Distinct values of each column with count n, n_le (values <= x) and n_total.

    With ``weight``, a column of whole numbers, a row counts that many times.
    """
    cells = chunked_form(df, columns, [weight] if weight else (), cuts)
    rows = F.sum(weight) if weight else F.count("*")
    return running_totals(cells.groupBy("feature", "chunk", "x").agg(rows.alias("n")), ["n"])


def order_statistic(position: Column) -> Column:
    """Aggregate over ranked values: the value at a zero-based position in sorted order."""
    return F.min(F.when(F.col("n_le") > position, F.col("x")))


def quantile(share: float) -> list[Column]:
    """Aggregates over ranked values that ``interpolated`` turns into a quantile."""
    at = (F.col("n_total") - 1) * F.lit(share)
    return [
        order_statistic(F.floor(at)).alias("below"),
        order_statistic(F.least(F.floor(at) + 1, F.col("n_total") - 1)).alias("above"),
        F.max(at - F.floor(at)).alias("part"),
    ]


def interpolated(parts: Column) -> Column:
    """Quantile with linear interpolation between the two nearest order statistics."""
    return parts["below"] + (parts["above"] - parts["below"]) * parts["part"]


def exact_quantile(
    df: DataFrame,
    column: str,
    share: float,
    chunks: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """One row, one column ``quantile``: exact, with linear interpolation.

    With ``weight``, a column of whole numbers, a row counts that many times.

    Approximate quantiles with a guaranteed error enclose the wanted one; only the values
    between them, some percent of all, are ranked, and the smaller ones are counted.
    """
    times = F.lit(1) if weight is None else F.col(weight)
    values = df.select(number(column).alias("x"), times.cast("long").alias("times")).where(F.col("x").isNotNull())
    around = [max(0.0, share - 0.01), min(1.0, share + 0.01)]
    low, high = values.approxQuantile("x", around, 0.005) or [-inf, inf]
    rows, below, enclosed = values.agg(
        *[F.coalesce(F.sum(F.when(kept, F.col("times"))), F.lit(0))
          for kept in (F.lit(True), F.col("x") < low, F.col("x") <= high)]
    ).first()
    at = max(rows - 1, 0) * share
    first, second = int(at), min(int(at) + 1, max(rows - 1, 0))
    if below <= first and second < enclosed:
        values = values.where(F.col("x").between(low, high))
    else:
        below = 0
    ranked = ranked_values(values, ["x"], chunker(values, ["x"], chunks), "times")
    lower = order_statistic(F.lit(first - below))
    upper = order_statistic(F.lit(second - below))
    return ranked.agg((lower + (upper - lower) * F.lit(at - first)).alias("quantile"))
