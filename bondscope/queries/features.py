"""Features, split, stores for predictions and metrics."""

from pyspark.sql import functions as F

from bondscope.functions import columns, split
from bondscope.operators import evaluation, lots, models
from bondscope.queries import pairs
from bondscope.queries.analysis import ORACLE as ANALYSIS_ORACLE
from bondscope.queries.analysis import column_drift
from bondscope.queries.tables import load
from bondscope.sources import results
from bondscope.storage import fresh_path

RUN = "manual__2024-09-06T14:59:35.008"
OTHER_RUN = "manual__2024-09-07T14:59:35.008"
ORDER_KEY = ("o_orderkey",)


def datetime_parts(spark, sf):
    return columns.time_parts(load(spark, sf, "events"))


def one_hot(spark, sf):
    orders = load(spark, sf, "orders")
    return columns.one_hot(orders, columns.categories(orders))


def text_columns(spark, sf):
    orders = load(spark, sf, "orders")
    return orders.select("o_orderkey", *columns.text_columns(orders))


def _written_times(spark, sf):
    odd = F.when(F.col("o_orderstatus") == "P", F.lit("not a date"))
    written = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return load(spark, sf, "orders").select("o_orderkey", written.alias("good"), F.coalesce(odd, written).alias("mixed"))


def parse_timestamp(spark, sf):
    return columns.to_times(_written_times(spark, sf).drop("mixed"), ["good"])


def parse_mixed_timestamp(spark, sf):
    return columns.to_times(_written_times(spark, sf).drop("good"), ["mixed"], strict=False)


def hash_split(spark, sf):
    train, test = split.split(load(spark, sf, "orders"), ORDER_KEY)
    return lots.union_of(
        train.withColumn("side", F.lit("train")), test.withColumn("side", F.lit("test"))
    )


def exact_split(spark, sf):
    train, test = split.exact_split(load(spark, sf, "orders"), ORDER_KEY)
    return lots.union_of(
        train.withColumn("side", F.lit("train")), test.withColumn("side", F.lit("test"))
    )


def problem_type(spark, sf):
    rows = load(spark, sf, "lineitem")
    kinds = {t: models.problem_type(rows, t) for t in (
        ("l_quantity", "l_tax"), ("l_linenumber",), ("l_linenumber", "l_suppkey"), ("l_tax",)
    )}
    entries = [
        F.struct(F.lit(",".join(t)).alias("targets"), F.lit(kind).alias("problem_type"))
        for t, kind in kinds.items()
    ]
    return rows.agg(F.count("*").alias("rows")).select("rows", F.inline(F.array(*entries)))


def clean_run_id(spark, sf):
    raw = F.concat_ws("__", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    return load(spark, sf, "orders").select(
        "o_orderkey",
        columns.clean_run_id(raw).alias("run_id"),
        columns.clean_run_id(raw, only_colon=True).alias("colon_run_id"),
    )


def _order_predictions(spark, sf, factor):
    return load(spark, sf, "orders").select(
        F.col("o_orderkey"), F.round(F.col("o_totalprice") * factor, 2).alias("o_totalprice")
    )


def _saved_predictions(spark, sf):
    path = fresh_path(spark, "predictions")
    results.save_predictions(_order_predictions(spark, sf, 3.0), path, "price", RUN)
    results.save_predictions(_order_predictions(spark, sf, 1.5), path, "price", OTHER_RUN)
    results.save_predictions(_order_predictions(spark, sf, 2.0), path, "price", RUN)
    return path


def stored_predictions(spark, sf):
    """A repeated run replaces itself and leaves the other run alone."""
    saved = spark.read.parquet(_saved_predictions(spark, sf))
    return saved.groupBy("model_id", "run_id").agg(
        F.count("*").alias("rows"), F.round(F.max("o_totalprice"), 2).alias("largest")
    )


def loaded_predictions(spark, sf):
    path = _saved_predictions(spark, sf)
    return results.load_predictions(spark, path, "price", RUN, ["o_totalprice"], ORDER_KEY)


def metric_log(spark, sf):
    path = fresh_path(spark, "log")
    metrics = evaluation.error_metrics(pairs._pairs(spark, sf), pairs.TARGETS)
    boosting = {"iterations": 1000, "learning_rate": 0.1}
    results.append_log(results.metric_rows(metrics, "multi_y_regressor", RUN), path)
    results.append_log(results.parameter_rows(spark, boosting, "multi_y_regressor", RUN), path)
    log = results.read_log(spark, path).drop("logged_at")
    number = F.round(F.expr("try_cast(value as double)"), 6)
    return log.select("model_id", "run_id", "kind", "name", number.alias("number"),
                      F.when(number.isNull(), F.col("value")).alias("text"))


def prediction_records(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = fresh_path(spark, "records")
    results.write_records(results.json_records(orders, model_id="price", run_id=RUN), path)
    return spark.read.text(path).withColumnRenamed("value", "record")


def drift_report_file(spark, sf):
    path = fresh_path(spark, "report")
    report = column_drift(spark, sf)
    results.write_report(report, path)
    return spark.read.schema(report.schema).json(path)


QUERIES = {
    f.__name__: f
    for f in (
        datetime_parts, one_hot, text_columns, parse_timestamp, parse_mixed_timestamp, hash_split,
        exact_split, problem_type, clean_run_id, stored_predictions, loaded_predictions, metric_log,
        prediction_records, drift_report_file,
    )
}

_PARTS = ", ".join(
    f"CAST({part}(ts) AS INT) AS ts_{part}"
    for part in ("year", "month", "day", "hour", "minute", "second")
)
_STATUS = ", ".join(f"CAST(o_orderstatus = '{v}' AS INT) AS \"o_orderstatus_{v}\"" for v in "FOP")
_PRIORITY = ", ".join(
    f"CAST(o_orderpriority = '{v}' AS INT) AS \"o_orderpriority_{v}\""
    for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
)
_MARKS = """'!"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~'"""
_RAW_RUN = "concat_ws('__', o_orderpriority, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'))"

ORACLE = {
    "datetime_parts": f"SELECT event_id, user_id, event_type, value, props, {_PARTS} FROM events",
    "one_hot": f"SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, {_STATUS}, {_PRIORITY} FROM orders",
    "text_columns": "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders",
    "parse_timestamp": "SELECT o_orderkey, date_trunc('second', o_orderdate) AS good FROM orders",
    "parse_mixed_timestamp": """
        SELECT o_orderkey,
               CASE WHEN o_orderstatus <> 'P' THEN date_trunc('second', o_orderdate) END AS mixed
        FROM orders""",
    "hash_split": """
        SELECT *, CASE WHEN md5(CAST(o_orderkey AS VARCHAR)) < '33333333' THEN 'test' ELSE 'train' END
            AS side FROM orders""",
    "exact_split": """
        SELECT * EXCLUDE (place), CASE WHEN place <= ceil(0.2 * (SELECT count(*) FROM orders))
            THEN 'test' ELSE 'train' END AS side
        FROM (SELECT *, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR))) AS place FROM orders)""",
    "problem_type": " UNION ALL ".join(
        f"SELECT count(*) AS rows, '{t}' AS targets, '{kind}' AS problem_type FROM lineitem"
        for t, kind in (
            ("l_quantity,l_tax", "multi_y_regression"),
            ("l_linenumber", "single_y_classification"),
            ("l_linenumber,l_suppkey", "multi_y_classification"),
            ("l_tax", "single_y_regression"),
        )
    ),
    "clean_run_id": f"""
        SELECT o_orderkey, translate({_RAW_RUN}, {_MARKS}, repeat('-', 32)) AS run_id,
               replace({_RAW_RUN}, ':', '-') AS colon_run_id
        FROM orders""",
    "stored_predictions": """
        SELECT 'price' AS model_id, 'manual--2024-09-06T14-59-35-008' AS run_id, count(*) AS rows,
               round(max(o_totalprice * 2), 2) AS largest FROM orders
        UNION ALL
        SELECT 'price', 'manual--2024-09-07T14-59-35-008', count(*),
               round(max(o_totalprice * CAST(1.5 AS DOUBLE)), 2) FROM orders""",
    "loaded_predictions": """
        SELECT o_orderkey, round(o_totalprice * 2, 2) AS o_totalprice FROM orders""",
    "metric_log": f"""
        WITH metrics AS ({pairs.METRICS_SQL})
        SELECT 'multi_y_regressor' AS model_id, '{RUN}' AS run_id, * FROM (
            {' UNION ALL '.join(
                f"SELECT 'metric' AS kind, '{m}' AS name, round({m}, 6) AS number, "
                f"CAST(NULL AS VARCHAR) AS text FROM metrics" for m in evaluation.METRICS)}
            UNION ALL SELECT 'parameter', 'iterations', 1000, NULL
            UNION ALL SELECT 'parameter', 'learning_rate', 0.1, NULL
            UNION ALL SELECT 'parameter', 'model_status', NULL, 'normal')""",
    "prediction_records": f"""
        SELECT CAST(to_json({{'model_id': 'price', 'run_id': '{RUN}', 'o_orderkey': o_orderkey,
            'o_orderstatus': o_orderstatus, 'o_totalprice': o_totalprice}}) AS VARCHAR) AS record
        FROM orders""",
    "drift_report_file": ANALYSIS_ORACLE["column_drift"],
}
