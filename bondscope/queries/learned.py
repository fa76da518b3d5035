"""Models: no SQL equivalent, so these are checked by rows and by tests.

The models of the lines take all rounds (``WHOLE``), the others few (``SHORT``); all rows of the tables take part.
"""

from pyspark.sql import functions as F

from bondscope.functions.split import split
from bondscope.operators import models
from bondscope.plans import workflows
from bondscope.queries.tables import ITEMS, LINE_KEY, lineitem, load
from bondscope.storage import fresh_path

WHOLE = models.Symmetric()
SHORT = models.Boosting(iterations=3, depth=3)
FEATURES = ("l_extendedprice", "l_linestatus", "l_shipdate")
TARGETS = ("l_quantity", "l_discount")
EVENT_FEATURES = ("ts", "value")


def _fitted(spark, sf):
    train, test = split(lineitem(spark, sf), LINE_KEY)
    return models.fit(train, FEATURES, TARGETS, WHOLE, key=LINE_KEY), test


def regression(spark, sf):
    model, test = _fitted(spark, sf)
    return models.score(model, test, FEATURES, TARGETS, LINE_KEY)


def _event_classes(spark, sf):
    kinds = F.array(*[F.lit(i) for i in ITEMS])
    return load(spark, sf, "events").withColumns(
        {
            "kind": (F.array_position(kinds, F.col("event_type")) - 1).cast("int"),
            "large": (F.col("value") > 10).cast("int"),
        }
    )


def classification_of_two(spark, sf):
    rows = _event_classes(spark, sf)
    features = ("ts", "user_id", "event_type")
    model = models.fit(rows, features, ["large"], SHORT)
    return models.score(model, rows, features, ["large"], ["event_id"])


def classification_of_many(spark, sf):
    rows = _event_classes(spark, sf)
    model = models.fit(rows, EVENT_FEATURES, ["kind", "large"], SHORT)
    return models.score(model, rows, EVENT_FEATURES, ["kind", "large"], ["event_id"])


def batch_scoring(spark, sf):
    """Rows with a missing feature are not scored; every other key keeps its own prediction."""
    rows = lineitem(spark, sf)
    price = F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice"))
    model, _ = _fitted(spark, sf)
    return models.score(model, rows.withColumn("l_extendedprice", price), FEATURES, TARGETS, LINE_KEY)


def saved_model(spark, sf):
    model, test = _fitted(spark, sf)
    base = fresh_path(spark, "models")
    models.save_model(model, spark, base, "lines")
    models.save_model(model, spark, base, "lines")
    latest = models.load_model(spark, base, "lines")
    scored = models.score(latest, test, FEATURES, TARGETS, LINE_KEY)
    return scored.withColumn("version", F.lit(models.latest_version(spark, base, "lines")))


def model_parameters(spark, sf):
    model, _ = _fitted(spark, sf)
    found = models.parameters(model)
    return lineitem(spark, sf).agg(
        F.count("*").alias("rows"),
        F.lit(found["iterations"]).alias("iterations"),
        F.lit(found["learning_rate"]).alias("learning_rate"),
    )


def _trained(spark, sf, base):
    qa = load(spark, sf, "events").withColumnRenamed("user_id", "mapping_uid")
    motion = load(spark, sf, "customer").withColumnRenamed("c_custkey", "mapping_uid")
    roles = {
        "features": ("c_acctbal", "c_mktsegment"),
        "targets": ("view", "click"),
        "order": ("event_id",),
        "items": ITEMS,
    }
    qa = qa.withColumnRenamed("event_type", "measure_item")
    done = workflows.train(
        qa, motion, base, "users", "run:1", boosting=SHORT, limit=1e9, **roles
    )
    return qa, motion, roles, done


def training(spark, sf):
    _, _, _, done = _trained(spark, sf, fresh_path(spark, "training"))
    return done.metrics


def retraining(spark, sf):
    base = fresh_path(spark, "retraining")
    qa, motion, roles, first = _trained(spark, sf, base)
    second = workflows.retrain(
        qa, motion, base, "users", "run:2", boosting=SHORT, limit=1e9, **roles
    )
    return second.metrics.withColumn("version", F.lit(second.version))


def _predicted(spark, sf, base):
    qa, motion, roles, _ = _trained(spark, sf, base)
    return qa, motion, roles, workflows.predict(
        spark, motion, base, "users", "run:3", features=roles["features"], targets=roles["targets"]
    )


def prediction(spark, sf):
    return _predicted(spark, sf, fresh_path(spark, "prediction"))[-1]


def evaluation_of_run(spark, sf):
    base = fresh_path(spark, "evaluation")
    qa, motion, roles, _ = _predicted(spark, sf, base)
    metrics, keys = workflows.evaluate(
        qa, motion, base, "users", "run:3",
        targets=roles["targets"], items=ITEMS, order=roles["order"],
    )
    return metrics.withColumn("keys_match", keys.select("keys_match").scalar())


QUERIES = {
    f.__name__: f
    for f in (
        regression, classification_of_two, classification_of_many, batch_scoring, saved_model,
        model_parameters, training, retraining, prediction, evaluation_of_run,
    )
}
