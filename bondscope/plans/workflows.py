"""The five data workflows, put together from the operators."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from bondscope import names
from bondscope.functions.split import split
from bondscope.operators import boosting as boosting_trees
from bondscope.operators import drift, evaluation, lots, models, outliers, profile, wide
from bondscope.operators.boosting import Symmetric, SymmetricModel
from bondscope.sources import results
from bondscope.storage import settled


@dataclass(frozen=True)
class DriftReport:
    """Drift and profiles of the current lots against the reference period."""

    columns: DataFrame
    dataset: DataFrame
    profile: DataFrame
    times: DataFrame


@dataclass(frozen=True)
class Training:
    """A fitted model with its test metrics and the decision to keep it."""

    model: PipelineModel | SymmetricModel
    metrics: DataFrame
    accepted: bool
    version: int | None


def find_outliers(
    motion: DataFrame,
    dates,
    lot_ids,
    sensors: Sequence[str] = names.SENSORS,
    key: Sequence[str] = (names.KEY,),
    date_column: str = names.DATE,
    lot_column: str = names.LOT,
    contamination: float = outliers.CONTAMINATION,
) -> DataFrame:
    """Outlier rows among the rows of the given lots."""
    current = lots.lots(motion, lots.lot_pairs(dates, lot_ids), date_column, lot_column)
    columns = profile.listed_numeric(motion, sensors)
    return outliers.outliers(current, columns, key, contamination)


def find_drift(
    motion: DataFrame,
    dates,
    lot_ids,
    sensors: Sequence[str] = names.SENSORS,
    key: Sequence[str] = (names.KEY,),
    date_column: str = names.DATE,
    lot_column: str = names.LOT,
    time_column: str = names.TIME,
    reference_rows: int = lots.REFERENCE_ROWS,
) -> DriftReport | None:
    """The given lots against the newest rows before them; None without earlier rows."""
    earlier = lots.before(motion, dates, date_column)
    if evaluation.is_empty(earlier):
        return None
    reference = lots.newest(earlier, reference_rows, time_column, key)
    current = lots.lots(motion, lots.lot_pairs(dates, lot_ids), date_column, lot_column)
    columns = profile.listed_numeric(motion, sensors)
    by_column = drift.column_drift(reference, current, columns)
    times = [profile.time_profile(side, time_column) for side in (reference, current)]
    return DriftReport(
        columns=by_column,
        dataset=drift.dataset_drift(by_column),
        profile=profile.profile_both(reference, current, columns),
        times=times[0].unionByName(times[1]),
    )


def _chosen(df: DataFrame, dates, lot_ids, date_column: str, lot_column: str) -> DataFrame:
    """Rows of the given lots; all rows without dates."""
    return df if dates is None else lots.lots(df, lots.lot_pairs(dates, lot_ids), date_column, lot_column)


def train(
    qa: DataFrame,
    motion: DataFrame,
    base: str,
    model_id: str,
    run_id: str,
    features: Sequence[str] = names.MODEL_FEATURES,
    targets: Sequence[str] = names.SCOPE_TARGETS,
    key: Sequence[str] = (names.KEY,),
    items: Sequence[str] = names.QA_ITEMS,
    order: Sequence[str] = (),
    boosting: models.Boosting | Symmetric = Symmetric(),
    limit: float = 50.0,
    keep_if: str = "<=",
    dates=None,
    lot_ids=None,
    date_column: str = names.DATE,
    lot_column: str = names.LOT,
    parent: int | None = None,
) -> Training:
    """Fit on the train rows of the given lots, measure on their test rows, keep the model if accepted.

    With ``parent``, a stored version of symmetric trees, the new version goes on from its
    trees; ``boosting`` then only tells how many more rounds to take.
    """
    spark = motion.sparkSession
    qa, motion = (_chosen(df, dates, lot_ids, date_column, lot_column) for df in (qa, motion))
    rows = wide.lot_view(qa, motion, items, key, order=order)
    # Every boosting pass would repeat the pivot and the join, so they are stored once.
    rows = settled(rows.select(*dict.fromkeys([*key, *features, *targets])).na.drop())
    train_rows, test_rows = split(rows, key)
    if parent is None:
        model = models.fit(train_rows, features, targets, boosting, key=key)
    else:
        stored = models.load_model(spark, f"{base}/models", model_id, parent)
        model = boosting_trees.extend(stored, train_rows, boosting.iterations, key)
    predictions = models.score(model, test_rows, features, targets, key)
    pairs = evaluation.aligned(predictions, test_rows, targets, key)
    metrics = evaluation.gate(evaluation.error_metrics(pairs, targets), limit=limit, keep_if=keep_if)
    found = metrics.first()  # one row of five numbers
    if not found["accepted"]:
        return Training(model, metrics, False, None)
    version = models.save_model(model, spark, f"{base}/models", model_id, parent)
    measured = spark.createDataFrame([found], metrics.schema).drop("accepted")
    log = f"{base}/log"
    results.append_log(results.metric_rows(measured, model_id, run_id), log)
    results.append_log(
        results.parameter_rows(spark, models.parameters(model), model_id, run_id), log
    )
    return Training(model, measured, True, version)


def retrain(
    qa: DataFrame,
    motion: DataFrame,
    base: str,
    model_id: str,
    run_id: str,
    *args,
    version: int | str = "latest",
    **settings,
) -> Training:
    """Go on from a stored version and save the result as the next one, with its parent.

    Takes the parameters of ``train``. Symmetric trees are continued on the new rows; a
    pipeline of Spark boosters cannot be, so it is fitted anew.
    """
    spark = motion.sparkSession
    stored = models.load_model(spark, f"{base}/models", model_id, version)
    if version == "latest":
        version = models.latest_version(spark, f"{base}/models", model_id)
    goes_on = isinstance(stored, SymmetricModel) and isinstance(settings.get("boosting", Symmetric()), Symmetric)
    return train(qa, motion, base, model_id, run_id, *args, parent=version if goes_on else None, **settings)


def predict(
    spark: SparkSession,
    motion: DataFrame,
    base: str,
    model_id: str,
    run_id: str,
    version: int | str = "latest",
    features: Sequence[str] = names.MODEL_FEATURES,
    targets: Sequence[str] = names.SCOPE_TARGETS,
    key: Sequence[str] = (names.KEY,),
    dates=None,
    lot_ids=None,
    date_column: str = names.DATE,
    lot_column: str = names.LOT,
) -> DataFrame:
    """Score whole lots with a saved model, store the predictions and read them back."""
    motion = _chosen(motion, dates, lot_ids, date_column, lot_column)
    model = models.load_model(spark, f"{base}/models", model_id, version)
    predictions = models.score(model, motion, features, targets, key)
    path = f"{base}/predictions"
    results.save_predictions(predictions, path, model_id, run_id)
    return results.load_predictions(spark, path, model_id, run_id, targets, key)


def evaluate(
    qa: DataFrame,
    motion: DataFrame,
    base: str,
    model_id: str,
    run_id: str,
    targets: Sequence[str] = names.SCOPE_TARGETS,
    key: Sequence[str] = (names.KEY,),
    items: Sequence[str] = names.QA_ITEMS,
    order: Sequence[str] = (),
    dates=None,
    lot_ids=None,
    date_column: str = names.DATE,
    lot_column: str = names.LOT,
) -> tuple[DataFrame, DataFrame]:
    """Metrics of stored predictions against ground truth, logged, and the key check."""
    spark = qa.sparkSession
    qa, motion = (_chosen(df, dates, lot_ids, date_column, lot_column) for df in (qa, motion))
    predictions = results.load_predictions(
        spark, f"{base}/predictions", model_id, run_id, targets, key
    )
    truth = wide.ground_truth(qa, motion, items, key, order=order)
    pairs = evaluation.aligned(predictions, truth, targets, key)
    metrics = evaluation.error_metrics(pairs, targets)
    measured = spark.createDataFrame(metrics.collect(), metrics.schema)  # one row
    results.append_log(results.metric_rows(measured, model_id, run_id), f"{base}/log")
    return measured, evaluation.key_check(predictions, truth, key)
