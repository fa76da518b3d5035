"""Corpus preparation in five stages, each written as Parquet before the next."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bondscope.llm import decontamination, exact_dedup, mixing, near_dedup, toxicity
from bondscope.llm.common import documents, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, the longest, then the one of the smallest doc_id.

    Texts move once: rows meet the kept ids and are told apart from their repeats by the same
    key. A null doc_id is an id of its own here; all columns come back, whatever their names.
    """
    key = "_key"
    while key in docs.columns:
        key += "_"
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    sha = F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]", ""), 256)
    kept = exact_dedup.exact_groups(docs).where("kept").select(F.concat_ws("|", doc_id, "text_sha256").alias(key)).distinct()
    rows = docs.withColumn(key, F.concat_ws("|", doc_id, sha)).join(kept, key, "left_semi")
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.length("text").desc(), F.col("text")))
    rank = key + "_rank"
    return rows.withColumn(rank, place).where(F.col(rank) == 1).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    gone = near_dedup.near_groups(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = found.where("contaminated").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs.doc_id.eqNullSafe(gone.gone_id), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


#: Model scores and seeded draws have no SQL form; the stages are tested one by one.
ORACLE_SQL = None
