"""Laid-out tables, daily sketches and rows that cannot be read, on the test tables."""

import uuid

from pyspark.sql import functions as F

from bondscope.operators import sketches
from bondscope.operators.ranks import long_form
from bondscope.queries.pairs import LOT_VIEW_OF_LOTS_SQL
from bondscope.queries.tables import ITEMS, LINE_SENSORS, events, lineitem, load
from bondscope.sources import store, tables
from bondscope.storage import fresh_path, handed_over

SHARES = (0.05, 0.25, 0.5, 0.75, 0.95)


def laid_out_lot_view(spark, sf):
    """The lot view from tables partitioned by day and bucketed by key; the tables go afterwards."""
    mark = uuid.uuid4().hex
    customers = load(spark, sf, "customer").withColumnsRenamed({"c_custkey": "mapping_uid"}).withColumns(
        {"date": F.lit("2024-01-05").cast("date"), "lot_id": F.lit("all")})
    qa = events(spark, sf).withColumnsRenamed({"user_id": "mapping_uid", "event_type": "measure_item"})
    qa = qa.select("mapping_uid", "measure_item", "value", "event_id", "date", "lot_id")
    try:
        for df, name in ((customers, "motion"), (qa, "qa")):
            store.save_laid_out(df, f"{name}_{mark}", buckets=8)
        days = [("2024-01-05", i) for i in ITEMS]
        motion = store.chosen_lots(spark, f"motion_{mark}", [("2024-01-05", "all")]).drop("date", "lot_id")
        view = store.lot_view(store.chosen_lots(spark, f"qa_{mark}", days), motion, ITEMS, order=["event_id"])
        view = view.select(F.col("mapping_uid").alias("user_id"), *ITEMS, "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
        return handed_over(view, "laid-out")[0]
    finally:
        for name in ("motion", "qa"):
            spark.sql(f"DROP TABLE IF EXISTS {name}_{mark}")


def sketched_profile(spark, sf):
    """Exact parts of merged daily sketches, and whether every quantile keeps its rank error."""
    rows = lineitem(spark, sf)
    daily = handed_over(sketches.daily_sketches(
        rows, LINE_SENSORS, "l_shipdate", "l_returnflag"), "sketches")[0]
    found = sketches.quantiles(sketches.merged(daily), SHARES)
    cells = long_form(rows, LINE_SENSORS).withColumn(
        "column_name", F.get(F.array(*[F.lit(c) for c in LINE_SENSORS]), "feature")).drop("feature")
    cells = cells.where("x IS NOT NULL").join(F.broadcast(found.select("column_name", "quantiles")), "column_name")
    inside = F.lit(True)
    for i, share in enumerate(SHARES):
        q, n = F.get("quantiles", F.lit(i)), F.count("*")
        below, upto = F.count_if(F.col("x") < q) / n, F.count_if(F.col("x") <= q) / n
        inside = inside & (below - sketches.RANK_ERROR <= share) & (upto + sketches.RANK_ERROR >= share)
    kept = cells.groupBy("column_name").agg(inside.alias("within_rank_error"))
    return found.join(kept, "column_name").select("column_name", "n", "missing", "min", "max", "within_rank_error")


def unreadable_rows(spark, sf):
    """Every tenth order has a price that is no number, every seventh a field too few."""
    orders = load(spark, sf, "orders")
    price = F.when(F.col("o_orderkey") % 10 == 0, "free").otherwise(F.col("o_orderkey").cast("string"))
    status = F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_orderstatus"))
    path = fresh_path(spark, "unreadable")
    lines = orders.select(F.concat_ws(",", F.col("o_orderkey").cast("string"), price, status).alias("value"))
    lines.write.text(path)
    good, bad = tables.checked_csv(spark, path, "o_orderkey long, price double, status string", header=False)
    return good.groupBy(F.lit("read").alias("reason")).agg(F.count("*").alias("rows")).unionByName(
        bad.groupBy("reason").agg(F.count("*").alias("rows")))


QUERIES = {f.__name__: f for f in (laid_out_lot_view, sketched_profile, unreadable_rows)}

ORACLE = {
    "laid_out_lot_view": LOT_VIEW_OF_LOTS_SQL,
    "sketched_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, count(*) - count({c}) AS missing, min({c})::DOUBLE AS min, "
        f"max({c})::DOUBLE AS max, true AS within_rank_error FROM lineitem" for c in LINE_SENSORS),
    "unreadable_rows": """
        SELECT CASE WHEN o_orderkey % 70 = 0 THEN 'not of its type, or missing: price, status'
            WHEN o_orderkey % 10 = 0 THEN 'not of its type, or missing: price'
            WHEN o_orderkey % 7 = 0 THEN 'not of its type, or missing: status' ELSE 'read' END AS reason,
          count(*) AS rows
        FROM orders GROUP BY 1""",
}
