"""The folder every executor can reach, for checkpoints and hand-over tables."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only on a local master."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="bondscope-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder or context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/bondscope/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later jobs read the stored rows and survive a lost executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def handed_over(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write rows to a path of their own and read them back; ``removed`` takes the path away again."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it knows it: any store that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def removed(spark: SparkSession, path: str) -> None:
    """Delete a hand-over table that no later job reads."""
    files, place = file_system(spark, path)
    files.delete(place, True)
