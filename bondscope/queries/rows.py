"""Sources, projections, filters, top rows, unions."""

from pyspark.sql import functions as F

from bondscope.functions import columns
from bondscope.operators import lots, profile
from bondscope.queries.tables import LINE_KEY, events, lineitem, load
from bondscope.sources import tables as files
from bondscope.storage import fresh_path

PAIRS = lots.lot_pairs(
    ["2024-01-05", "2024-01-05", "2024-01-07", "2024-01-09"], ["click", "click", "view"]
)
TRAIN, TEST = [("2024-01-05", "click"), ("2024-01-06", "click")], [("2024-01-07", "click")]


def scan_customer(spark, sf):
    return load(spark, sf, "customer")


def discovered_columns(spark, sf):
    return files.filled_cells(load(spark, sf, "lineitem"))


def parquet_round_trip(spark, sf):
    path = fresh_path(spark, "orders")
    files.write_parquet(load(spark, sf, "orders"), path)
    return files.parquet(spark, path)


def csv_round_trip(spark, sf):
    orders, path = load(spark, sf, "orders"), fresh_path(spark, "orders")
    files.write_csv(orders, path)
    return files.read_csv(spark, path, orders.schema)


def split_csv_round_trip(spark, sf):
    rows = events(spark, sf)
    train, test = lots.split_by_lots(rows, TRAIN, TEST)
    paths = fresh_path(spark, "train"), fresh_path(spark, "test")
    files.save_split(train, test, *paths)
    train, test = files.load_split(spark, *paths, rows.schema)
    both = lots.union_of(
        train.withColumn("side", F.lit("train")), test.withColumn("side", F.lit("test"))
    )
    return both.select("side", "event_id", "ts", "event_type", "value", "date")


def projection(spark, sf):
    return columns.chosen(
        lineitem(spark, sf), ["l_quantity", "l_tax"], ["l_discount"], key=LINE_KEY
    )


def column_drop(spark, sf):
    return columns.without(load(spark, sf, "orders"), "o_orderkey", "o_custkey")


def label_split(spark, sf):
    rows = lineitem(spark, sf)
    x, y = columns.label_columns(
        rows.columns, labels=["l_quantity", "l_discount"], key=LINE_KEY, exclude=["l_tax"]
    )
    return rows.select(*[F.col(c).alias(f"x_{c}") for c in x], *[F.col(c).alias(f"y_{c}") for c in y])


def lot_filter(spark, sf):
    return lots.lot(events(spark, sf), "2024-01-05", "click")


def lot_filter_on_timestamp(spark, sf):
    rows = load(spark, sf, "events")
    return rows.where(lots.on_days("ts", "2024-01-05") & (F.col("event_type") == "click"))


def before_date(spark, sf):
    return lots.before(events(spark, sf), ["2024-01-12", "2024-01-10"])


def several_lots(spark, sf):
    return lots.lots(events(spark, sf), PAIRS)


def complete_rows(spark, sf):
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return columns.complete_rows(load(spark, sf, "events").withColumn("value", value), ["value"])


def nan_to_null(spark, sf):
    value = F.when(F.col("event_type") == "error", float("nan")).otherwise(F.col("value"))
    return columns.nan_to_null(load(spark, sf, "events").withColumn("value", value))


def listed_numeric(spark, sf):
    rows = load(spark, sf, "lineitem")
    return rows.select(profile.listed_numeric(rows, ["l_tax", "l_humidity", "l_quantity"]))


def scaled_amount(spark, sf):
    orders = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("amount")
    )
    return columns.scaled(orders, "amount").withColumn("amount", F.round("amount", 6))


def newest_events(spark, sf):
    earlier = lots.before(events(spark, sf), "2024-01-20")
    return lots.newest(earlier, 2_000, "ts", ["event_id"])


def newest_lineitems(spark, sf):
    return lots.newest(lineitem(spark, sf), 20_000, "l_shipdate", LINE_KEY)


def newest_by_text(spark, sf):
    """The order is a text with very few values, so that nearly every row is a tie."""
    return lots.newest(load(spark, sf, "orders"), 5_000, "o_orderpriority", ["o_orderkey"])


def newest_repeated_rows(spark, sf):
    """Every row three times: copies at the last place are as good as each other."""
    rows = lineitem(spark, sf)
    return lots.newest(rows.unionAll(rows).unionAll(rows), 12_500, "l_shipdate", LINE_KEY)


def reference_period(spark, sf):
    return lots.newest(lots.before(events(spark, sf), "2024-01-20"), order="ts", key=["event_id"])


def first_rows_of_lot(spark, sf):
    return lots.first_rows(lots.lot(events(spark, sf), "2024-01-05", "click"), ["event_id"], 100)


def union_of_lots(spark, sf):
    rows = events(spark, sf)
    return lots.union_of(*[lots.lot(rows, day, kind) for day, kind in TRAIN + TEST])


def split_by_lots(spark, sf):
    train, test = lots.split_by_lots(events(spark, sf), TRAIN, TEST)
    return lots.union_of(
        train.withColumn("side", F.lit("train")), test.withColumn("side", F.lit("test"))
    )


QUERIES = {
    f.__name__: f
    for f in (
        scan_customer, discovered_columns, parquet_round_trip, csv_round_trip,
        split_csv_round_trip, projection, column_drop, label_split, lot_filter,
        lot_filter_on_timestamp, before_date, several_lots, complete_rows, nan_to_null,
        listed_numeric, scaled_amount, newest_events, newest_lineitems, newest_by_text, newest_repeated_rows,
        reference_period,
        first_rows_of_lot, union_of_lots, split_by_lots,
    )
}

_LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
_EVENTS = "(SELECT *, CAST(ts AS DATE) AS date, event_type AS lot_id FROM events)"
_SIDES = f"""
    SELECT *, 'train' AS side FROM {_EVENTS}
    WHERE lot_id = 'click' AND date IN (DATE '2024-01-05', DATE '2024-01-06')
    UNION ALL
    SELECT *, 'test' AS side FROM {_EVENTS} WHERE lot_id = 'click' AND date = DATE '2024-01-07'
"""

ORACLE = {
    "scan_customer": "SELECT * FROM customer",
    "discovered_columns": " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, count({c}) AS filled FROM lineitem"
        for i, c in enumerate(_LINE_COLUMNS)
    ),
    "parquet_round_trip": "SELECT * FROM orders",
    "csv_round_trip": "SELECT * FROM orders",
    "split_csv_round_trip": f"SELECT side, event_id, ts, event_type, value, date FROM ({_SIDES})",
    "projection": """
        SELECT l_orderkey, l_linenumber, l_extendedprice AS price_key, l_quantity, l_tax, l_discount
        FROM lineitem""",
    "column_drop": "SELECT o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
    "label_split": """
        SELECT l_partkey AS x_l_partkey, l_suppkey AS x_l_suppkey,
               l_extendedprice AS x_l_extendedprice, l_returnflag AS x_l_returnflag,
               l_linestatus AS x_l_linestatus, l_shipdate AS x_l_shipdate,
               l_quantity AS y_l_quantity, l_discount AS y_l_discount
        FROM lineitem""",
    "lot_filter": f"SELECT * FROM {_EVENTS} WHERE date = DATE '2024-01-05' AND lot_id = 'click'",
    "lot_filter_on_timestamp": """
        SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05' AND event_type = 'click'""",
    "before_date": f"SELECT * FROM {_EVENTS} WHERE date < DATE '2024-01-10'",
    "several_lots": f"""
        SELECT * FROM {_EVENTS} WHERE date = DATE '2024-01-05' AND lot_id = 'click'
        UNION ALL
        SELECT * FROM {_EVENTS} WHERE date = DATE '2024-01-05' AND lot_id = 'click'
        UNION ALL
        SELECT * FROM {_EVENTS} WHERE date = DATE '2024-01-07' AND lot_id = 'view'""",
    "complete_rows": "SELECT * FROM events WHERE event_type <> 'error' AND value IS NOT NULL",
    "nan_to_null": """
        SELECT event_id, ts, user_id, event_type,
               CASE WHEN event_type <> 'error' THEN value END AS value, props
        FROM events""",
    "listed_numeric": "SELECT l_tax, l_quantity FROM lineitem",
    "scaled_amount": """
        SELECT o_orderkey AS order_id, round(o_totalprice * CAST(1.1 AS DOUBLE), 6) AS amount
        FROM orders""",
    "newest_events": f"""
        SELECT * FROM {_EVENTS} WHERE date < DATE '2024-01-20'
        ORDER BY ts DESC, event_id LIMIT 2000""",
    "newest_lineitems": """
        SELECT *, l_extendedprice AS price_key FROM lineitem
        ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_extendedprice LIMIT 20000""",
    "newest_by_text": "SELECT * FROM orders ORDER BY o_orderpriority DESC, o_orderkey LIMIT 5000",
    "newest_repeated_rows": """
        SELECT lineitem.*, l_extendedprice AS price_key FROM lineitem, range(3) AS copies(i)
        ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_extendedprice LIMIT 12500""",
    "reference_period": f"""
        SELECT * FROM {_EVENTS} WHERE date < DATE '2024-01-20'
        ORDER BY ts DESC, event_id LIMIT 400000""",
    "first_rows_of_lot": f"""
        SELECT * FROM {_EVENTS} WHERE date = DATE '2024-01-05' AND lot_id = 'click'
        ORDER BY event_id LIMIT 100""",
    "union_of_lots": f"""
        SELECT * FROM {_EVENTS} WHERE lot_id = 'click'
        AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-07'""",
    "split_by_lots": _SIDES,
}
