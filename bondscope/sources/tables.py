"""Reading and writing tables and files."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bondscope import names
from bondscope.functions.columns import nan_to_null


def table(spark: SparkSession, name: str = names.MOTION_TABLE) -> DataFrame:
    """A catalog table; columns and filters chosen later reach its scan."""
    return spark.table(name)


def parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file or folder."""
    return spark.read.parquet(path)


def columns_of(df: DataFrame) -> list[str]:
    """Column names, from the schema alone."""
    return list(df.columns)


def filled_cells(df: DataFrame) -> DataFrame:
    """One row per column found: position, name, number of values that are not NULL."""
    counts = df.agg(*[F.count(c).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.col(f"c{i}").alias("filled"))
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*rows)))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a Parquet folder, one file per task."""
    df.write.mode(mode).parquet(path)


# The default patterns of the CSV source cut timestamps to milliseconds, and its defaults trim
# text and read empty text as null. A null is \\N, a mark that escaped text cannot hold.
_OPTIONS = {
    "header": "true",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\\N",
    "escape": '"',
}
BAD_ROW = "_bad_row"


def _escaped(c: Column) -> Column:
    """Text without line breaks, so that files stay splittable: backslash, line feed, carriage return."""
    for plain, mark in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(plain), F.lit(mark))
    return c


def _restored(c: Column) -> Column:
    """Takes the escapes out again; pairs of backslashes are set aside first."""
    pieces = F.split(c, r"\\\\")
    back = lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return F.array_join(F.transform(pieces, back), "\\")


def _texts(schema: StructType) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, StringType)]


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a CSV folder with a header in every file; any text comes back as it was."""
    escaped = df.withColumns({c: _escaped(F.col(c)) for c in _texts(df.schema)})
    escaped.write.mode(mode).options(**_OPTIONS).csv(path)


def _schema(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Read CSV with a header and a known schema; NaN becomes NULL.

    The schema saves the extra pass that type inference needs, and parses timestamps.
    """
    return checked_csv(spark, path, schema)[0]


def checked_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    header: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with their ``line`` and the ``reason``, from the same scan of the text.

    A row is bad if it has another number of fields than the schema or a value that is not of
    its type. Good rows have every column of the schema.
    """
    wanted = _schema(schema)
    found = spark.read.options(**_OPTIONS | {"header": header}, columnNameOfCorruptRecord=BAD_ROW, mode="PERMISSIVE").schema(
        StructType([*(StructField(f.name, f.dataType) for f in wanted), StructField(BAD_ROW, StringType())])).csv(path)
    # Always true, and reads every column: one that is pruned would not be checked.
    found = found.where(F.xxhash64(*[F.col(f"`{f.name}`") for f in wanted]) >= F.lit(-(2**63)))
    good = found.where(F.col(BAD_ROW).isNull()).drop(BAD_ROW)
    good = nan_to_null(good.withColumns({c: _restored(F.col(c)) for c in _texts(wanted)}))
    unread = F.concat_ws(", ", *[F.when(F.col(f"`{f.name}`").isNull(), F.lit(f.name)) for f in wanted])
    reason = F.concat(F.lit("not of its type, or missing: "), unread)
    return good, found.where(F.col(BAD_ROW).isNotNull()).select(F.col(BAD_ROW).alias("line"), reason.alias("reason"))


def save_split(train: DataFrame, test: DataFrame, train_path: str, test_path: str) -> None:
    """Write train and test frames as CSV folders."""
    write_csv(train, train_path)
    write_csv(test, test_path)


def load_split(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    schema: StructType | str,
) -> tuple[DataFrame, DataFrame]:
    """Read the frames written by ``save_split``."""
    return read_csv(spark, train_path, schema), read_csv(spark, test_path, schema)
