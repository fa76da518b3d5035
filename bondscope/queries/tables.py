"""The test tables under the roles they play in the queries."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_KEY = ("l_orderkey", "l_linenumber", "price_key")
LINE_SENSORS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
ITEMS = ("click", "error", "purchase", "signup", "view")
DRIFT_CUT = "1997-01-01"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a date and a lot."""
    rows = load(spark, folder, "events")
    return rows.withColumns({"date": F.to_date("ts"), "lot_id": F.col("event_type")})


def lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """Lineitem with the price once more as a part of the key."""
    return load(spark, folder, "lineitem").withColumn("price_key", F.col("l_extendedprice"))


def reference(spark: SparkSession, folder: str) -> DataFrame:
    cut = F.lit(DRIFT_CUT).cast("timestamp_ntz")
    return lineitem(spark, folder).where(F.col("l_shipdate") < cut)


def current(spark: SparkSession, folder: str) -> DataFrame:
    cut = F.lit(DRIFT_CUT).cast("timestamp_ntz")
    return lineitem(spark, folder).where(F.col("l_shipdate") >= cut)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round columns as the check SQL does."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})
