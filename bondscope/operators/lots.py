"""Choosing rows: lots, reference periods, newest rows."""

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bondscope import names
from bondscope.operators.selection import first_in_order

# Fixed value: rows in the reference period of the drift report.
REFERENCE_ROWS = 400_000


def _as_list(value) -> list:
    return [value] if isinstance(value, (str, Date)) else list(value)


def lot(df: DataFrame, date, lot_id, date_column=names.DATE, lot_column=names.LOT) -> DataFrame:
    """Rows of one lot."""
    return df.where((F.col(date_column) == F.lit(date)) & (F.col(lot_column) == F.lit(lot_id)))


def lot_pairs(dates, lot_ids) -> list[tuple]:
    """Pair dates with lots in order; a single value is a list of one, a longer list is cut."""
    return list(zip(_as_list(dates), _as_list(lot_ids)))


def lots(
    df: DataFrame,
    pairs: Sequence[tuple],
    date_column: str = names.DATE,
    lot_column: str = names.LOT,
) -> DataFrame:
    """Rows of several lots in one scan; a pair given twice returns its rows twice."""
    dates = df.select(F.col(date_column)).schema[0].dataType
    lot_ids = df.select(F.col(lot_column)).schema[0].dataType
    wanted = df.sparkSession.createDataFrame(
        [(str(d), str(i)) for d, i in pairs], "wanted_date string, wanted_lot string"
    ).select(
        F.col("wanted_date").cast(dates).alias(date_column),
        F.col("wanted_lot").cast(lot_ids).alias(lot_column),
    )
    # The IN list reaches the file scan; the list of pairs is a run parameter, so it is small.
    days = [F.lit(str(d)).cast(dates) for d in sorted({str(d) for d, _ in pairs})]
    selected = df.where(F.col(date_column).isin(days))
    return selected.join(F.broadcast(wanted), [date_column, lot_column]).select(*df.columns)


def on_days(column: str, first: str, days: int = 1) -> Column:
    """Range predicate for whole days of a timestamp column; unlike a cast it reaches the scan."""
    start = F.lit(first).cast("date")
    return (F.col(column) >= start.cast("timestamp_ntz")) & (
        F.col(column) < F.date_add(start, days).cast("timestamp_ntz")
    )


def earliest(dates) -> str:
    """Earliest of the given 'YYYY-MM-DD' dates."""
    return min(_as_list(dates), key=lambda d: Date.fromisoformat(str(d)))


def before(df: DataFrame, dates, date_column: str = names.DATE) -> DataFrame:
    """Rows strictly before the earliest of the dates."""
    kind = df.schema[date_column].dataType
    return df.where(F.col(date_column) < F.lit(str(earliest(dates))).cast(kind))


def newest(
    df: DataFrame,
    n: int = REFERENCE_ROWS,
    order: str = names.TIME,
    key: Sequence[str] = (names.KEY,),
    chunks: int | None = None,
) -> DataFrame:
    """The n newest rows by ``order``; rows of equal time are taken in the order of the key.

    One way for every n and every orderable type: see ``selection``. ``chunks`` tells how small a
    part of the rows may be sorted at last. Rows without a time come last.
    """
    most = None if chunks is None else max(1, df.count() // chunks)
    return first_in_order(df, n, order, key, most)


def first_rows(df: DataFrame, key: Sequence[str] = (names.KEY,), n: int | None = None) -> DataFrame:
    """The first n rows in the order of the key; the whole frame without n."""
    return df if n is None else df.orderBy(*key).limit(n)


def union_of(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name, repeats kept."""
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def split_by_lots(
    df: DataFrame,
    train: Sequence[tuple],
    test: Sequence[tuple],
    date_column: str = names.DATE,
    lot_column: str = names.LOT,
) -> tuple[DataFrame, DataFrame]:
    """Train and test frames by lists of (date, lot) pairs."""
    return lots(df, train, date_column, lot_column), lots(df, test, date_column, lot_column)
