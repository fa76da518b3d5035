"""Column rules and scalar features."""

import string
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondscope import names

# Suffixes of the timestamp parts.
TIME_PARTS = {
    "year": F.year,
    "month": F.month,
    "day": F.day,
    "hour": F.hour,
    "minute": F.minute,
    "second": F.second,
}
# Most values a text column may have for one column per value.
MAX_CATEGORIES = 1_000


def chosen(df: DataFrame, features: Sequence[str], targets: Sequence[str], key=(names.KEY,)) -> DataFrame:
    """Key, features and targets; every other column is dropped."""
    return df.select(*dict.fromkeys([*key, *features, *targets]))


def without(df: DataFrame, *columns: str) -> DataFrame:
    """The frame without some columns."""
    return df.drop(*columns)


def label_columns(
    columns: Sequence[str],
    labels: Sequence[str] = names.TARGETS,
    key: Sequence[str] = (names.KEY,),
    exclude: Sequence[str] = names.QA_ITEMS,
) -> tuple[list[str], list[str]]:
    """Feature and label names. Measurements that are no label would leak and are excluded;
    pass ``exclude=()`` to keep them among the features."""
    y = [c for c in columns if c in labels]
    x = [c for c in columns if c not in {*key, *labels, *exclude}]
    return x, y


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without NULL or NaN in the columns (all columns by default)."""
    return df.na.drop("any", subset=None if columns is None else list(columns))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every column."""
    return df.replace(float("nan"), None)


def scaled(df: DataFrame, column: str, factor: float = 1.1) -> DataFrame:
    """Multiply a column by a factor."""
    return df.withColumn(column, F.col(column) * F.lit(factor))


def time_columns(df: DataFrame) -> list[str]:
    """Columns of a timestamp type."""
    kinds = (T.TimestampType, T.TimestampNTZType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds)]


def text_columns(df: DataFrame) -> list[str]:
    """Columns of string type."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def time_parts(df: DataFrame) -> DataFrame:
    """Replace every timestamp column by its year, month, day, hour, minute and second."""
    columns = time_columns(df)
    parts = {f"{c}_{name}": part(c) for c in columns for name, part in TIME_PARTS.items()}
    return df.withColumns(parts).drop(*columns) if columns else df


def categories(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    limit: int = MAX_CATEGORIES,
) -> dict[str, list[str]]:
    """Values of each text column in order; an error for a column with too many.

    Fit this on the training rows only and use it for every later batch, so that all
    batches get the same columns.
    """
    columns = text_columns(df) if columns is None else list(columns)
    found = {}
    for c in columns:
        rows = df.select(c).where(F.col(c).isNotNull()).distinct().limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError(f"{c} has more than {limit} values; it is not a category")
        found[c] = sorted(r[0] for r in rows)
    return found


def one_hot(df: DataFrame, values: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace text columns by one 0/1 column ``<column>_<value>`` per value, at the end."""
    flags = [
        F.coalesce((F.col(c) == v).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c, found in values.items()
        for v in found
    ]
    return df.select(*[c for c in df.columns if c not in values], *flags)


def to_times(df: DataFrame, columns: Sequence[str], strict: bool = True) -> DataFrame:
    """Parse columns as timestamps; with ``strict=False`` bad text becomes NULL."""
    parse = F.to_timestamp_ntz if strict else lambda c: F.expr(f"try_cast(`{c}` as timestamp_ntz)")
    return df.withColumns({c: parse(c if not strict else F.col(c)) for c in columns})


def clean_run_id(column: Column, only_colon: bool = False) -> Column:
    """Run id usable in a path: ASCII punctuation (or only the colon) becomes a dash."""
    marks = ":" if only_colon else string.punctuation
    return F.translate(column, marks, "-" * len(marks))
