"""Gradient-boosted models for one or several targets, kept as one Spark ML pipeline."""

import math
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondscope import names
from bondscope.functions.columns import MAX_CATEGORIES, TIME_PARTS, categories, complete_rows
from bondscope.functions.columns import text_columns, time_columns
from bondscope.operators import boosting as boosting_trees
from bondscope.operators.boosting import Symmetric, SymmetricModel
from bondscope.sources import registry
from bondscope.storage import shared_folder

VECTOR = "_features"
RAW = "_raw_"
PREDICTED = "predicted_"
# Rows of one task in the passes of a Spark booster.
ROWS_PER_TASK = 200_000


@dataclass(frozen=True)
class Boosting:
    """Settings of the boosting; the defaults are fixed values."""

    iterations: int = 1000
    learning_rate: float = 0.1
    depth: int = 6
    seed: int = 42


def problem_type(df: DataFrame, targets: Sequence[str]) -> str:
    """``single_y_`` or ``multi_y_`` by the number of targets, classification for integers."""
    kinds = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    whole = all(isinstance(df.schema[t].dataType, kinds) for t in targets)
    count = "multi_y" if len(targets) > 1 else "single_y"
    return f"{count}_{'classification' if whole else 'regression'}"


def _feature_stages(train: DataFrame, features: Sequence[str], max_categories: int) -> list:
    """Stages from raw features to one vector; categories are fitted on the training rows."""
    inputs = train.select(*features)
    times, texts = time_columns(inputs), text_columns(inputs)
    stages, vector = [], [f for f in features if f not in times and f not in texts]
    if times:
        parts = {f"_{c}_{part}": f"double({part}(`{c}`))" for c in times for part in TIME_PARTS}
        columns = ", ".join(f"{value} AS `{name}`" for name, value in parts.items())
        stages.append(SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__"))
        vector += list(parts)
    if texts:
        indexed, encoded = [f"_i_{c}" for c in texts], [f"_h_{c}" for c in texts]
        found = categories(inputs, texts, max_categories)
        # A value unseen in training gets the extra place, so its row is still scored.
        indexer = StringIndexerModel.from_arrays_of_labels(
            [found[c] for c in texts], texts, indexed, handleInvalid="keep"
        )
        encoder = OneHotEncoder(
            inputCols=indexed, outputCols=encoded, dropLast=False, handleInvalid="error"
        ).fit(indexer.transform(inputs))
        stages += [indexer, encoder]
        vector += encoded
    stages.append(VectorAssembler(inputCols=vector, outputCol=VECTOR))
    return stages


def _fit_regressor(shaped: DataFrame, target: str, boosting: Boosting) -> list:
    booster = GBTRegressor(
        featuresCol=VECTOR,
        labelCol=target,
        predictionCol=PREDICTED + target,
        maxIter=boosting.iterations,
        stepSize=boosting.learning_rate,
        maxDepth=boosting.depth,
        seed=boosting.seed,
    )
    return [booster.fit(shaped)]


def _fit_classifier(shaped: DataFrame, target: str, boosting: Boosting, max_classes: int) -> list:
    found = shaped.select(target).distinct().limit(max_classes + 1).collect()
    if len(found) > max_classes:
        raise ValueError(f"{target} has more than {max_classes} values; it is not a class")
    classes = sorted(row[0] for row in found)
    place = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(target)) - 1
    labelled = shaped.select(VECTOR, place.cast("double").alias("_label"))
    booster = GBTClassifier(
        featuresCol=VECTOR,
        labelCol="_label",
        predictionCol=f"_place_{target}",
        maxIter=boosting.iterations,
        stepSize=boosting.learning_rate,
        maxDepth=boosting.depth,
        seed=boosting.seed,
    )
    every = "*"
    if len(classes) > 2:
        # The boosters inside lose a raw column of another name when they are saved, so the
        # default name stays and its column goes before the next target.
        every = f"* EXCEPT ({booster.getRawPredictionCol()})"
        booster = OneVsRest(
            classifier=booster, featuresCol=VECTOR, labelCol="_label", predictionCol=f"_place_{target}")
    else:
        booster.setRawPredictionCol(RAW + target).setProbabilityCol(f"_probability_{target}")
    values = ", ".join(str(c) for c in classes)
    back = f"element_at(array({values}), int(`_place_{target}`) + 1)"
    named = SQLTransformer(statement=f"SELECT {every}, {back} AS `{PREDICTED}{target}` FROM __THIS__")
    return [booster.fit(labelled), named]


def spread(data: DataFrame) -> DataFrame:
    """The same rows in tasks of about ROWS_PER_TASK, as they are when one task has no more.

    A split of a compressed file opens into many times its size as vectors, which every pass
    of the boosting reads again: its bytes do not bound a task, its rows do.
    """
    most, rows = data.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    if not rows or most <= ROWS_PER_TASK:
        return data
    return data.repartition(math.ceil(rows / ROWS_PER_TASK))


def fit(
    train: DataFrame,
    features: Sequence[str] = names.MODEL_FEATURES,
    targets: Sequence[str] = names.SCOPE_TARGETS,
    boosting: Boosting | Symmetric = Symmetric(),
    parallel: int = 4,
    max_categories: int = MAX_CATEGORIES,
    key: Sequence[str] = (),
) -> PipelineModel | SymmetricModel:
    """Fit symmetric trees, or with ``Boosting`` one Spark booster per target over a shared vector.

    Rows with a missing feature or target are left out. The result holds everything from
    raw features to predictions, so training and scoring cannot differ in their columns.
    """
    if isinstance(boosting, Symmetric):
        return boosting_trees.fit(train, features, targets, boosting, key)
    shared_folder(train.sparkSession)  # long boosting cuts its lineage by checkpoints
    data = complete_rows(train.select(*dict.fromkeys([*features, *targets])))
    stages = _feature_stages(data, features, max_categories)
    shaped = PipelineModel(stages).transform(spread(data)).select(VECTOR, *targets).persist()
    classify = problem_type(train, targets).endswith("classification")

    @inheritable_thread_target(train.sparkSession)
    def fit_one(target: str) -> list:
        if classify:
            return _fit_classifier(shaped, target, boosting, max_categories)
        return _fit_regressor(shaped, target, boosting)

    try:
        with ThreadPool(min(parallel, len(targets))) as pool:
            fitted = pool.map(fit_one, targets)
    finally:
        shaped.unpersist()
    return PipelineModel(stages + [stage for stages_of_one in fitted for stage in stages_of_one])


def score(
    model: PipelineModel | SymmetricModel,
    df: DataFrame,
    features: Sequence[str] = names.MODEL_FEATURES,
    targets: Sequence[str] = names.SCOPE_TARGETS,
    key: Sequence[str] = (names.KEY,),
) -> DataFrame:
    """Key and one prediction per target for every row with complete features.

    The key travels in the row, so predictions cannot move to another key. No shuffle.
    """
    if isinstance(model, SymmetricModel):
        return boosting_trees.score(model, df, key).select(*key, *targets)
    inputs = df.select(*dict.fromkeys([*key, *features]))
    scored = model.transform(complete_rows(inputs, features))
    return scored.select(*key, *[F.col(PREDICTED + t).alias(t) for t in targets])


def parameters(model: PipelineModel | SymmetricModel) -> dict[str, object]:
    """Iterations and learning rate of the boosters in the model."""
    if isinstance(model, SymmetricModel):
        return {"iterations": max(map(len, model.trees)), "learning_rate": model.settings.learning_rate}
    for stage in model.stages:
        booster = stage.models[0] if hasattr(stage, "models") else stage
        if hasattr(booster, "trees"):
            return {"iterations": booster.getMaxIter(), "learning_rate": booster.getStepSize()}
    raise ValueError("the model has no booster")


def latest_version(spark: SparkSession, base: str, model_id: str) -> int:
    """Newest complete version of a model; 0 without one."""
    return max(registry.versions(spark, base, model_id), default=0)


def save_model(
    model: PipelineModel | SymmetricModel,
    spark: SparkSession,
    base: str,
    model_id: str,
    parent: int | None = None,
) -> int:
    """Save the model as the next version under its name and return the version."""
    if isinstance(model, SymmetricModel):
        return registry.publish(
            spark, base, model_id, lambda path: boosting_trees.save(model, spark, path), kind="symmetric", parent=parent)
    return registry.publish(spark, base, model_id, lambda path: model.write().save(path), kind="pipeline", parent=parent)


def load_model(
    spark: SparkSession,
    base: str,
    model_id: str,
    version: int | str = "latest",
) -> PipelineModel | SymmetricModel:
    """Load a version of a model by name."""
    if version == "latest":
        version = latest_version(spark, base, model_id)
    if version not in registry.versions(spark, base, model_id):
        raise ValueError(f"no version of {model_id} below {base}")
    path = registry.version_path(base, model_id, version)
    if registry.facts(spark, base, model_id, version)["kind"] == "symmetric":
        return boosting_trees.load(spark, path)
    return PipelineModel.load(path)
