"""Stores for predictions, metrics, parameters, records and reports."""

import string
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondscope import names
from bondscope.storage import file_system

# Fixed value: status logged with the parameters of a model.
MODEL_STATUS = "normal"


def _run_folder(spark: SparkSession, path: str, model_id: str, run_id: str) -> str:
    """Folder of one run, named as Spark names partitions; ids stay text, so 1 is not 01."""
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    marks = str.maketrans(string.punctuation, "-" * len(string.punctuation))
    return f"{path}/model_id={escaped(model_id)}/run_id={escaped(run_id.translate(marks))}"


def save_predictions(predictions: DataFrame, path: str, model_id: str, run_id: str) -> None:
    """Store the predictions of one run; a repeated run replaces itself, also by no rows, and no other run."""
    predictions.write.mode("overwrite").parquet(_run_folder(predictions.sparkSession, path, model_id, run_id))


def load_predictions(
    spark: SparkSession,
    path: str,
    model_id: str,
    run_id: str,
    targets: Sequence[str],
    key: Sequence[str] = (names.KEY,),
) -> DataFrame:
    """Key and targets of one run; only its folder is read. A run that was never stored has no rows."""
    folder = _run_folder(spark, path, model_id, run_id)
    files, place = file_system(spark, folder)
    if files.exists(place):
        return spark.read.parquet(folder).select(*key, *targets)
    return spark.read.parquet(path).where(F.lit(False)).select(*key, *targets)


def _tidy(kind: str, model_id: str, run_id: str) -> list[Column]:
    return [
        F.lit(model_id).alias("model_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(kind).alias("kind"),
    ]


def metric_rows(metrics: DataFrame, model_id: str, run_id: str) -> DataFrame:
    """Metrics as one row per metric; the values are text, as parameters are not all numbers."""
    entries = [
        F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"))
        for c in metrics.columns
    ]
    return metrics.select(*_tidy("metric", model_id, run_id), F.inline(F.array(*entries)))


def parameter_rows(
    spark: SparkSession,
    parameters: Mapping[str, object],
    model_id: str,
    run_id: str,
) -> DataFrame:
    """Model parameters as one row per parameter, with the model status."""
    rows = {**parameters, "model_status": MODEL_STATUS}
    frame = spark.createDataFrame([(k, str(v)) for k, v in rows.items()], "name string, value string")
    return frame.select(*_tidy("parameter", model_id, run_id), "name", "value")


def append_log(rows: DataFrame, path: str) -> None:
    """Append metric or parameter rows to the log table."""
    rows.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log table."""
    return spark.read.parquet(path)


def json_records(df: DataFrame, **constants: str) -> DataFrame:
    """One column ``record``: each row as a JSON object, with constant fields such as run ids.

    Missing values are null fields; JSON has no NaN, which becomes null too.
    """
    fields = [F.lit(v).alias(k) for k, v in constants.items()]
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    values = [F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns]
    return df.select(F.to_json(F.struct(*fields, *values), {"ignoreNullFields": "false"}).alias("record"))


def write_records(records: DataFrame, path: str) -> None:
    """Write JSON records as lines of text."""
    records.write.mode("overwrite").text(path)


def write_report(report: DataFrame, path: str) -> None:
    """Write a report as JSON lines."""
    report.write.mode("overwrite").json(path)
