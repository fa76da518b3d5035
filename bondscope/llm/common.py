"""Helpers that the operators of this subpackage share."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bondscope.storage import fresh_path

SPACES = r"[\x20\x09-\x0D]+"
#: Bits of the filter on ids: at most 2^FILTER_BITS / 8 bytes (16 MB) are broadcast, whatever the ids.
FILTER_BITS = 27
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; null counts as 0."""
    return F.coalesce(F.size(F.filter(F.split(text, SPACES), lambda w: w != "")), F.lit(0)).cast("long")


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(sizes: DataFrame, key: str, size: str) -> DataFrame:
    """Keys with more rows than a fair share of one task, and the ways to split them.

    A share is (all rows) / (shuffle partitions), so at most that many keys are hot: the
    result may be broadcast whatever the size of the data.
    """
    share = sizes.agg(F.sum(size)).first()[0] or 0
    share = max(1, share // tasks(sizes.sparkSession))
    hot = sizes.where(F.col(size) > share)
    return hot.select(key, F.ceil(F.col(size) / share).cast("int").alias("_ways"))


def spread_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame, by: Column, how: str = "inner") -> DataFrame:
    """Join on ``key`` where hot keys of ``left`` are split by the hash of ``by``.

    Rows of ``right`` with a hot key are repeated once for each way.
    """
    hot = F.broadcast(hot)
    ways = F.coalesce("_ways", F.lit(1))
    left = left.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(by), ways).cast("int")).drop("_ways")
    right = right.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), ways - 1))).drop("_ways")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def rows_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose doc_id is among the distinct ``ids``. A bit filter lets few other texts into the shuffle.

    Blocks of 2^15 bits, one for each value of the upper bits of a hash, are broadcast. The ids
    meet the rows in an inner join: a semi join would be moved below the filter.
    """
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))
    blocks = ids.select(F.shiftright(spot, 15).alias("_block"), F.pmod(spot, F.lit(1 << 15)).alias("_at")).groupBy("_block").agg(
        F.bitmap_construct_agg("_at").alias("_bits"))
    at = F.pmod(spot, F.lit(1 << 15))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    likely = rows.withColumn("_block", F.shiftright(spot, 15)).join(F.broadcast(blocks), "_block").where(
        F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1)
    return likely.select(rows.columns).join(ids.select("doc_id").distinct(), "doc_id").select(rows.columns)
