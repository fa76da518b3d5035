"""Text columns with many values: dense ids, encoding of rows with unseen values, a linear model on them."""

from pyspark.sql import functions as F

from bondscope.functions.split import split
from bondscope.operators import dictionary
from bondscope.operators.dictionary import CategoryModel
from bondscope.queries.tables import load
from bondscope.storage import fresh_path

CUSTOMER_TEXT = ("c_name", "c_mktsegment")
ORDER_TEXT = ("o_orderday", "o_orderpriority")


def _orders(spark, sf):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return load(spark, sf, "orders").select("o_orderkey", day.alias("o_orderday"), "o_orderpriority", "o_totalprice")


def category_ids(spark, sf):
    return dictionary.dictionary(load(spark, sf, "customer"), CUSTOMER_TEXT)


def encoded_categories(spark, sf):
    """All orders, with the ids of the categories of the train rows; unseen days get one id more."""
    rows = _orders(spark, sf)
    table = dictionary.dictionary(split(rows, ("o_orderkey",))[0], ORDER_TEXT)
    return dictionary.encoded(rows, table, dictionary.dictionary_sizes(table, ORDER_TEXT)).drop("o_totalprice")


def category_regression(spark, sf):
    """Least squares on one place for each customer, saved and loaded: the mean of the customer's orders.

    The descent ends within about 1e-9 of the mean, so that the check rounds to a tenth of 7,000
    (7, as means of cents would often lie just between two rounded numbers).
    """
    rows = load(spark, sf, "orders").select("o_orderkey", F.format_string("C%09d", "o_custkey").alias("customer"), "o_totalprice")
    path = fresh_path(spark, "category-model")
    dictionary.fit_categories(rows, ["customer"], [], "o_totalprice", tolerance=1e-14).save(path)
    scored = CategoryModel.load(spark, path).score(rows)
    return scored.select("o_orderkey", "customer", F.round(F.col("prediction") / 7_000, 1).alias("prediction"))


QUERIES = {f.__name__: f for f in (category_ids, encoded_categories, category_regression)}

_IDS = """
    SELECT '{c}' AS feature, {c} AS category, row_number() OVER (ORDER BY {c}) - 1 AS id, count(*) AS rows
    FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}"""

ORACLE = {
    "category_ids": " UNION ALL ".join(_IDS.format(c=c, t="customer") for c in CUSTOMER_TEXT),
    "encoded_categories": f"""
        WITH all_rows AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderday, o_orderpriority FROM orders),
        train AS (SELECT * FROM all_rows WHERE md5(CAST(o_orderkey AS VARCHAR)) >= '33333333'),
        days AS ({_IDS.format(c="o_orderday", t="train")}),
        priorities AS ({_IDS.format(c="o_orderpriority", t="train")})
        SELECT o_orderkey, coalesce(d.id, CASE WHEN o_orderday IS NOT NULL THEN (SELECT count(*) FROM days) END) AS o_orderday,
               coalesce(p.id, CASE WHEN o_orderpriority IS NOT NULL THEN (SELECT count(*) FROM priorities) END) AS o_orderpriority
        FROM all_rows LEFT JOIN days d ON d.category = o_orderday LEFT JOIN priorities p ON p.category = o_orderpriority""",
    "category_regression": """
        SELECT o_orderkey, printf('C%09d', o_custkey) AS customer,
               round(avg(o_totalprice) OVER (PARTITION BY o_custkey) / 7000, 1) AS prediction FROM orders""",
}
