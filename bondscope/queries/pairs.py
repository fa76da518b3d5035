"""Widened measurements, joins to sensor records, predictions against truth."""

from pyspark.sql import functions as F

from bondscope.operators import evaluation, lots, wide
from bondscope.queries.tables import ITEMS, LINE_KEY, events, lineitem, load, reference, rounded

KEY = ("user_id",)
QA = {"items": ITEMS, "key": KEY, "item": "event_type", "value": "value"}
TARGETS = ("l_quantity", "l_tax")


def _customers(spark, sf):
    return load(spark, sf, "customer").withColumnRenamed("c_custkey", "user_id")


def lot_view(spark, sf):
    return wide.lot_view(load(spark, sf, "events"), _customers(spark, sf), order=["event_id"], **QA)


def lot_view_of_lots(spark, sf):
    days = [("2024-01-05", i) for i in ITEMS]
    qa = lots.lots(events(spark, sf), days)
    return wide.lot_view(qa, _customers(spark, sf), order=["event_id"], **QA)


def widened(spark, sf):
    return wide.widen(load(spark, sf, "events"), order=["ts", "event_id"], **QA)


def widened_with_nulls(spark, sf):
    value = F.when(F.col("value") >= 5, F.col("value"))
    rows = load(spark, sf, "events").withColumn("value", value)
    return wide.widen(rows, order=["event_id"], **QA)


def widened_without_nulls(spark, sf):
    value = F.when(F.col("value") >= 5, F.col("value"))
    rows = load(spark, sf, "events").withColumn("value", value)
    return wide.widen(rows, order=["event_id"], ignore_nulls=True, **QA)


def ground_truth(spark, sf):
    motion = load(spark, sf, "orders").withColumnRenamed("o_custkey", "user_id")
    return wide.ground_truth(load(spark, sf, "events"), motion, order=["event_id"], **QA)


def ground_truth_once(spark, sf):
    motion = load(spark, sf, "orders").withColumnRenamed("o_custkey", "user_id")
    return wide.ground_truth(
        load(spark, sf, "events"), motion, order=["event_id"], repeat_keys=False, **QA
    )


def _predictions(spark, sf):
    return lineitem(spark, sf).select(
        *LINE_KEY,
        (F.col("l_quantity") + 10 * F.col("l_discount") - 0.5).alias("l_quantity"),
        (0.9 * F.col("l_tax") + 0.01).alias("l_tax"),
    )


def _truth(spark, sf):
    # Truth is missing for returned lines, as some keys have no measurement.
    tax = F.when(F.col("l_linestatus") == "O", F.col("l_tax"))
    kept = lineitem(spark, sf).where(F.col("l_returnflag") != "R")
    return kept.withColumn("l_tax", tax).select(*LINE_KEY, *TARGETS)


def _pairs(spark, sf):
    return evaluation.aligned(_predictions(spark, sf), _truth(spark, sf), TARGETS, LINE_KEY)


def aligned_predictions(spark, sf):
    return rounded(_pairs(spark, sf), "predicted_l_quantity", "predicted_l_tax")


def key_check(spark, sf):
    customers = _customers(spark, sf)
    return evaluation.key_check(customers, load(spark, sf, "events"), KEY)


def key_check_of_lines(spark, sf):
    return evaluation.key_check(_predictions(spark, sf), _truth(spark, sf), LINE_KEY)


def error_metrics(spark, sf):
    return rounded(evaluation.error_metrics(_pairs(spark, sf), TARGETS), *evaluation.METRICS)


def metric_gate(spark, sf):
    metrics = evaluation.error_metrics(_pairs(spark, sf), TARGETS)
    above = evaluation.gate(metrics, keep_if=">").withColumnRenamed("accepted", "accepted_above")
    return rounded(evaluation.gate(above), "mse_score").select(
        "mse_score", "accepted", "accepted_above"
    )


def result_shape(spark, sf):
    return evaluation.shape(lot_view(spark, sf))


def empty_reference(spark, sf):
    old = lots.before(events(spark, sf), "2023-01-01")
    return lots.union_of(
        evaluation.empty_flag(old).withColumn("period", F.lit("before 2023")),
        evaluation.empty_flag(reference(spark, sf)).withColumn("period", F.lit("reference")),
    )


QUERIES = {
    f.__name__: f
    for f in (
        lot_view, lot_view_of_lots, widened, widened_with_nulls, widened_without_nulls,
        ground_truth, ground_truth_once, aligned_predictions, key_check, key_check_of_lines,
        error_metrics, metric_gate, result_shape, empty_reference,
    )
}


def _widened(order: str, source: str = "events", pick: str = "arg_min_null") -> str:
    columns = ", ".join(
        f"{pick}(value, {order}) FILTER (WHERE event_type = '{i}') AS {i}" for i in ITEMS
    )
    return f"SELECT user_id, {columns} FROM {source} GROUP BY user_id"


_ITEMS = ", ".join(f"w.{i}" for i in ITEMS)
_CUSTOMER = "c_name, c_nationkey, c_acctbal, c_mktsegment"
_NULLED = "(SELECT * REPLACE (CASE WHEN value >= 5 THEN value END AS value) FROM events)"
_DAY = "(SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05')"
_LOT_VIEW = f"""
    SELECT w.user_id, {_ITEMS}, {_CUSTOMER}
    FROM ({_widened('event_id')}) w JOIN customer c ON w.user_id = c.c_custkey"""
_PREDICTIONS = """
    (SELECT l_orderkey, l_linenumber, l_extendedprice AS price_key,
            l_quantity + 10 * l_discount - CAST(0.5 AS DOUBLE) AS l_quantity,
            CAST(0.9 AS DOUBLE) * l_tax + CAST(0.01 AS DOUBLE) AS l_tax
     FROM lineitem)"""
_TRUTH = """
    (SELECT l_orderkey, l_linenumber, l_extendedprice AS price_key, l_quantity,
            CASE WHEN l_linestatus = 'O' THEN l_tax END AS l_tax
     FROM lineitem WHERE l_returnflag <> 'R')"""
_PAIRS = f"""
    (SELECT t.l_orderkey, t.l_linenumber, t.price_key, t.l_quantity, t.l_tax,
            p.l_quantity AS predicted_l_quantity, p.l_tax AS predicted_l_tax
     FROM {_PREDICTIONS} p JOIN {_TRUTH} t
       ON p.l_orderkey = t.l_orderkey AND p.l_linenumber = t.l_linenumber
      AND p.price_key = t.price_key
     WHERE t.l_quantity IS NOT NULL AND t.l_tax IS NOT NULL)"""
METRICS_SQL = f"""
    SELECT ((1 - sum((l_quantity - predicted_l_quantity) ** 2) / (var_pop(l_quantity) * count(*)))
          + (1 - sum((l_tax - predicted_l_tax) ** 2) / (var_pop(l_tax) * count(*)))) / 2 AS r2_score,
           (avg((l_quantity - predicted_l_quantity) ** 2)
          + avg((l_tax - predicted_l_tax) ** 2)) / 2 AS mse_score,
           greatest(max(predicted_l_quantity - l_quantity), max(predicted_l_tax - l_tax)) AS pos_max_err,
           least(min(predicted_l_quantity - l_quantity), min(predicted_l_tax - l_tax)) AS neg_max_err
    FROM {_PAIRS}"""


def _key_check(predictions: str, truth: str, key: str) -> str:
    return f"""
        SELECT *, missing_in_truth = 0 AND missing_in_predictions = 0 AS keys_match FROM (
            SELECT (SELECT count(*) FROM (SELECT {key} FROM {predictions}
                    EXCEPT SELECT {key} FROM {truth})) AS missing_in_truth,
                   (SELECT count(*) FROM (SELECT {key} FROM {truth}
                    EXCEPT SELECT {key} FROM {predictions})) AS missing_in_predictions)"""


LOT_VIEW_OF_LOTS_SQL = f"""
    SELECT w.user_id, {_ITEMS}, {_CUSTOMER}
    FROM ({_widened('event_id', _DAY)}) w JOIN customer c ON w.user_id = c.c_custkey"""

ORACLE = {
    "lot_view": _LOT_VIEW,
    "lot_view_of_lots": LOT_VIEW_OF_LOTS_SQL,
    "widened": _widened("{'a': ts, 'b': event_id}"),
    "widened_with_nulls": _widened("event_id", _NULLED),
    "widened_without_nulls": _widened("event_id", _NULLED, "arg_min"),
    "ground_truth": f"""
        SELECT w.* FROM ({_widened('event_id')}) w JOIN orders o ON w.user_id = o.o_custkey""",
    "ground_truth_once": f"""
        SELECT w.* FROM ({_widened('event_id')}) w
        WHERE w.user_id IN (SELECT o_custkey FROM orders)""",
    "aligned_predictions": f"""
        SELECT * REPLACE (round(predicted_l_quantity, 6) AS predicted_l_quantity,
                          round(predicted_l_tax, 6) AS predicted_l_tax) FROM {_PAIRS}""",
    "key_check": _key_check("(SELECT c_custkey AS user_id FROM customer)", "events", "user_id"),
    "key_check_of_lines": _key_check(_PREDICTIONS, _TRUTH, "l_orderkey, l_linenumber, price_key"),
    "error_metrics": f"""
        SELECT round(r2_score, 6) AS r2_score, round(mse_score, 6) AS mse_score,
               round(pos_max_err, 6) AS pos_max_err, round(neg_max_err, 6) AS neg_max_err
        FROM ({METRICS_SQL})""",
    "metric_gate": f"""
        SELECT round(mse_score, 6) AS mse_score, mse_score <= 50 AS accepted,
               mse_score > 50 AS accepted_above
        FROM ({METRICS_SQL})""",
    "result_shape": f"SELECT count(*) AS rows_fetched, 10 AS columns_fetched FROM ({_LOT_VIEW})",
    "empty_reference": """
        SELECT count(*) = 0 AS is_empty, 'before 2023' AS period FROM events WHERE ts < '2023-01-01'
        UNION ALL
        SELECT count(*) = 0, 'reference' FROM lineitem WHERE l_shipdate < '1997-01-01'""",
}
