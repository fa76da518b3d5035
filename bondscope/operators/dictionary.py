"""Text columns as dense ids and sparse vectors, for any number of values.

The dictionary is a table, made by a range-sorted shuffle of the distinct values; rows meet it
in a join that splits frequent values. Nothing of it passes through the driver but one number
for each column.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bondscope.operators.joins import HOT_ROWS, HOT_SHARE, frequent_keys, join_spread
from bondscope.storage import settled

# monotonically_increasing_id: the partition above these bits, the place in it below.
PLACE_BITS = 33


def dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """feature, category, id and rows: ids from 0 without gaps, in the order of the values.

    Values are counted before the shuffle, so a frequent one costs no more than a rare one.
    Chunks of the order are sorted apart and their places moved by the sizes of the chunks
    before, a table of at most columns + partitions rows. Null is no category.
    """
    pair = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("category")) for c in columns]))
    values = df.select(pair.alias("_pair")).where("_pair.category IS NOT NULL")
    counts = values.groupBy("_pair.feature", "_pair.category").agg(F.count("*").alias("rows"))
    ordered = counts.repartitionByRange("feature", "category").sortWithinPartitions("feature", "category")
    # Stored: range bounds are drawn anew when a plan runs again.
    placed = settled(ordered.withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumns({
        "_chunk": F.shiftright("_at", PLACE_BITS), "_place": F.col("_at").bitwiseAND((1 << PLACE_BITS) - 1)})
    sizes = placed.groupBy("feature", "_chunk").agg(F.count("*").alias("n"), F.min("_place").alias("first"))
    earlier = Window.partitionBy("feature").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")
    starts = sizes.select("feature", "_chunk", start.alias("_start"))
    return placed.join(F.broadcast(starts), ["feature", "_chunk"]).select(
        "feature", "category", (F.col("_place") + F.col("_start")).alias("id"), "rows")


def dictionary_sizes(table: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Number of categories of each column."""
    found = dict(table.groupBy("feature").agg(F.count("*")).collect())  # one row per column
    return {c: found.get(c, 0) for c in columns}


def encoded(
    df: DataFrame,
    table: DataFrame,
    sizes: Mapping[str, int],
    hot_share: float = HOT_SHARE,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Replace the columns of ``sizes`` by their ids.

    A value that the dictionary does not have gets the id after the last; null stays null.
    Values that are frequent in ``df`` are spread over tasks, unknown values and null too.
    """
    columns = list(sizes)
    rows = df
    for c, hot in zip(columns, frequent_keys(df, [[c] for c in columns], hot_share, hot_rows)):
        known = table.where(F.col("feature") == c).select(F.col("category").alias(c), F.col("id").alias("_id"))
        joined = join_spread(rows, known, [c], hot, "left")
        found = F.coalesce("_id", F.when(F.col(c).isNotNull(), F.lit(sizes[c]).cast("long")))
        rows = joined.withColumn(c, found).select(*df.columns)
    return rows


def _encoder(spark: SparkSession, sizes: Mapping[str, int]):
    """Spark's encoder for ids up to one unknown; fitted on the largest id of each column alone."""
    columns = list(sizes)
    encoder = OneHotEncoder(
        inputCols=columns, outputCols=[f"{c}_vector" for c in columns], handleInvalid="keep", dropLast=True)
    largest = spark.createDataFrame([tuple(float(sizes[c]) for c in columns)], [*columns])
    return encoder.fit(largest)


def _without_nulls(ids: DataFrame, sizes: Mapping[str, int]) -> DataFrame:
    # One beyond the unknown: the encoder's place for it is the one that is left out.
    return ids.withColumns({c: F.coalesce(F.col(c), F.lit(n + 1)).cast("double") for c, n in sizes.items()})


def one_hot_vectors(df: DataFrame, table: DataFrame, sizes: Mapping[str, int], **spread) -> DataFrame:
    """Add a sparse vector ``<column>_vector`` for each column of ``sizes``, in place of the column.

    Its length is the number of categories and one, the last place being that of unknown
    values. Null is a vector of zeros, as in ``one_hot``.
    """
    ids = _without_nulls(encoded(df, table, sizes, **spread), sizes)
    return _encoder(df.sparkSession, sizes).transform(ids).drop(*sizes)


@dataclass(frozen=True)
class CategoryModel:
    """A linear model on numbers and sparse categories, with the dictionary it was fitted by."""

    pipeline: PipelineModel
    table: DataFrame
    sizes: Mapping[str, int]

    def save(self, path: str) -> None:
        self.pipeline.write().save(f"{path}/pipeline")
        self.table.write.parquet(f"{path}/dictionary")
        sizes = [(c, n) for c, n in self.sizes.items()]
        self.table.sparkSession.createDataFrame(sizes, "feature string, n long").coalesce(1).write.json(f"{path}/sizes")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "CategoryModel":
        sizes = spark.read.schema("feature string, n long").json(f"{path}/sizes").collect()  # one row per column
        return cls(PipelineModel.load(f"{path}/pipeline"), spark.read.parquet(f"{path}/dictionary"), dict(map(tuple, sizes)))

    def score(self, df: DataFrame, prediction: str = "prediction", **spread) -> DataFrame:
        """The rows with a prediction; a category that was not fitted adds the weight of unknown ones, 0."""
        rows = df.withColumns({f"_{c}_id": F.col(c) for c in self.sizes})
        sizes = {f"_{c}_id": n for c, n in self.sizes.items()}
        named = self.table.withColumn("feature", F.concat(F.lit("_"), "feature", F.lit("_id")))
        ids = _without_nulls(encoded(rows, named, sizes, **spread), sizes)
        return self.pipeline.transform(ids).select(*df.columns, F.col("_prediction").alias(prediction))


def fit_categories(
    df: DataFrame,
    columns: Sequence[str],
    numbers: Sequence[str],
    target: str,
    iterations: int = 100,
    penalty: float = 0.0,
    tolerance: float = 1e-6,
) -> CategoryModel:
    """Least squares on numbers and one place for each category, whatever their number.

    The weights (one double for each category) are summed by a tree of tasks and sent to them
    once an iteration. Rows with a null number or target are left out.
    """
    spark = df.sparkSession
    rows = df.select(*columns, *numbers, target).na.drop(subset=[*numbers, target])
    table = settled(dictionary(rows, columns))
    sizes = dictionary_sizes(table, columns)
    named = {f"_{c}_id": n for c, n in sizes.items()}
    encoder = _encoder(spark, named)
    assembler = VectorAssembler(inputCols=[*[f"_{c}_id_vector" for c in columns], *numbers], outputCol="_features")
    renamed = encoded(rows, table, sizes).withColumnsRenamed({c: f"_{c}_id" for c in columns})
    ready = assembler.transform(encoder.transform(_without_nulls(renamed, named)))
    ready = settled(ready.select("_features", F.col(target).cast("double").alias("_label")))
    linear = LinearRegression(
        featuresCol="_features", labelCol="_label", predictionCol="_prediction", solver="l-bfgs",
        maxIter=iterations, regParam=penalty, tol=tolerance).fit(ready)
    return CategoryModel(PipelineModel([encoder, assembler, linear]), table, sizes)
