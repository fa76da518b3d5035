import datetime as dt

import pytest
from pyspark.sql import functions as F

from bondscope import names
from bondscope.functions import columns, split
from bondscope.operators import evaluation, models
from bondscope.plans import workflows
from bondscope.sources import results, synthetic, tables
from bondscope.storage import fresh_path, shared_folder

FAST = models.Boosting(iterations=2, depth=2)


@pytest.fixture(scope="module")
def process(spark):
    made = synthetic.process_table(spark, 300)
    return made.withColumn("mapping_uid", F.date_format("proc_datetime", "yyyyMMddHHmm")).cache()


def test_names():
    assert len(names.SENSORS) == len(set(names.SENSORS)) == 168
    assert len(names.QA_ITEMS) == 18 and len(names.TARGETS) == 12


def test_synthetic_table(spark):
    df = synthetic.process_table(spark, 500)
    found = df.agg(F.min("heat_pre"), F.max("heat_pre"), F.avg("loop_height"), F.count_distinct("equipment_id"), F.count_distinct("lf_id")).first()
    assert 100 <= found[0] and found[1] <= 200 and abs(found[2] - 30) < 1 and found[3:] == (5, 3)
    assert df.orderBy("proc_datetime").first().proc_datetime == dt.datetime(2024, 1, 1)


def test_metrics_by_hand(spark):
    pairs = spark.createDataFrame([(1.0, 2.0, 1.0, 2.0), (3.0, 2.0, 5.0, 2.0)], "a double, b double, predicted_a double, predicted_b double")
    row = evaluation.error_metrics(pairs, ["a", "b"]).first()
    # a: squared errors 4 over a spread of 2; b is constant and met exactly.
    assert tuple(row) == (pytest.approx((-1 + 1) / 2), pytest.approx(1.0), 2.0, 0.0)


def test_constant_target_missed(spark):
    pairs = spark.createDataFrame([(2.0, 3.0), (2.0, 2.0)], "a double, predicted_a double")
    assert evaluation.error_metrics(pairs, ["a"]).first().r2_score == 0.0


def test_alignment_pairs_by_key(spark):
    predictions = spark.createDataFrame([("u", 1.0), ("v", 2.0), ("only", 3.0)], "mapping_uid string, a double")
    truth = spark.createDataFrame([("v", 20.0), ("u", 10.0), ("u", 10.0), ("w", None)], "mapping_uid string, a double")
    rows = evaluation.aligned(predictions, truth, ["a"]).collect()
    assert sorted(map(tuple, rows)) == [("u", 10.0, 1.0), ("v", 20.0, 2.0)]
    check = evaluation.key_check(predictions, truth).first()
    assert tuple(check) == (1, 1, False)


def test_conflicting_truth_is_an_error(spark):
    predictions = spark.createDataFrame([("u", 1.0)], "mapping_uid string, a double")
    truth = spark.createDataFrame([("u", 1.0), ("u", 2.0)], "mapping_uid string, a double")
    with pytest.raises(Exception, match="different values for one key"):
        evaluation.aligned(predictions, truth, ["a"]).collect()


def test_gate(spark):
    metrics = spark.createDataFrame([(60.0,)], "mse_score double")
    assert not evaluation.gate(metrics).first().accepted
    assert evaluation.gate(metrics, keep_if=">").first().accepted


def test_split_ignores_layout_and_exact_split_counts(spark):
    df = spark.range(1_001).select(F.col("id").cast("string").alias("mapping_uid"))
    sides = [{r[0] for r in split.split(d)[1].collect()} for d in (df, df.repartition(7))]
    assert sides[0] == sides[1] and 150 < len(sides[0]) < 250
    for chunks in (1, 4):
        train, test = split.exact_split(df, chunks=chunks)
        assert (train.count(), test.count()) == (800, 201)


def test_labels_leave_measurements_out():
    x, y = columns.label_columns(["mapping_uid", "heat_pre", "ball_shear", "anomaly_bb"])
    assert (x, y) == (["heat_pre"], ["ball_shear"])
    assert columns.label_columns(["anomaly_bb", "ball_shear"], exclude=())[0] == ["anomaly_bb"]


def test_one_hot_is_fitted_once(spark):
    train = spark.createDataFrame([("b", 1), ("a", 2)], "t string, n int")
    later = spark.createDataFrame([("c", 3), ("a", 4)], "t string, n int")
    found = columns.categories(train)
    assert columns.one_hot(later, found).columns == ["n", "t_a", "t_b"]
    assert [tuple(r) for r in columns.one_hot(later, found).orderBy("n").collect()] == [(3, 0, 0), (4, 1, 0)]
    with pytest.raises(ValueError, match="more than 1 values"):
        columns.categories(train, limit=1)


def test_run_id(spark):
    row = spark.range(1).select(
        columns.clean_run_id(F.lit("manual__2024-09-06T14:59:35.08+00:00")),
        columns.clean_run_id(F.lit("a:b_c"), only_colon=True),
    ).first()
    assert tuple(row) == ("manual--2024-09-06T14-59-35-08-00-00", "a-b_c")


def test_problem_type(spark):
    df = spark.createDataFrame([(1, 2, 1.0)], "a int, b long, c double")
    kinds = [models.problem_type(df, t) for t in (["a"], ["a", "b"], ["c"], ["a", "c"])]
    assert kinds == ["single_y_classification", "multi_y_classification", "single_y_regression", "multi_y_regression"]


def test_regression_learns_scores_and_reloads(spark, process, tmp_path):
    step = F.when(F.col("heat_pre") > 150, 10.0).otherwise(0.0)
    df = process.withColumn("loop_height", step).withColumn("ball_thickness", -step)
    features, targets = ["heat_pre", "equipment_id", "proc_datetime"], ["loop_height", "ball_thickness"]
    errors = []
    for rounds in (1, 8):
        model = models.fit(df, features, targets, models.Boosting(rounds, 0.1, 2))
        pairs = evaluation.aligned(models.score(model, df, features, targets), df, targets)
        errors.append(evaluation.error_metrics(pairs, targets).first().mse_score)
    assert errors[1] <= errors[0] < 1
    assert models.parameters(model) == {"iterations": 8, "learning_rate": 0.1}
    base = str(tmp_path)
    assert [models.save_model(model, spark, base, "m") for _ in range(2)] == [1, 2]
    again = models.load_model(spark, base, "m")
    before = models.score(model, df, features, targets).orderBy("mapping_uid").collect()
    assert models.score(again, df, features, targets).orderBy("mapping_uid").collect() == before
    with pytest.raises(ValueError, match="no version"):
        models.load_model(spark, base, "other")


def test_scoring_keeps_complete_rows_and_unseen_categories(spark, process):
    features, targets = ["heat_pre", "equipment_id"], ["loop_height"]
    model = models.fit(process, features, targets, FAST)
    first = process.orderBy("mapping_uid").limit(2).select("mapping_uid", *features)
    odd = first.withColumn("equipment_id", F.lit("EQ999"))
    gap = first.withColumns({"heat_pre": F.lit(None).cast("double"), "mapping_uid": F.lit("gap")})
    whole = {r[0]: r[1] for r in models.score(model, process, features, targets).collect()}
    assert models.score(model, odd, features, targets).count() == 2
    mixed = {r[0]: r[1] for r in models.score(model, gap.unionByName(first), features, targets).collect()}
    assert mixed == {k: whole[k] for k in mixed} and "gap" not in mixed and len(mixed) == 2


def test_classification_returns_the_classes(spark, process):
    df = process.withColumns({
        "kind": F.when(F.col("heat_pre") > 160, 7).when(F.col("heat_pre") > 130, 5).otherwise(2),
        "hot": F.when(F.col("heat_pre") > 150, 4).otherwise(3),
    })
    model = models.fit(df, ["heat_pre"], ["kind", "hot"], models.Boosting(4, 0.1, 3))
    scored = models.score(model, df, ["heat_pre"], ["kind", "hot"])
    right = scored.toDF("mapping_uid", "k", "h").join(df, "mapping_uid").where("k = kind and h = hot").count()
    assert right > 285


def test_predictions_and_log(spark, tmp_path):
    path = str(tmp_path / "p")
    for run, value in (("r:1", 1.0), ("r:2", 2.0), ("r:1", 3.0)):
        results.save_predictions(spark.createDataFrame([("u", value)], "mapping_uid string, a double"), path, "m", run)
    found = [results.load_predictions(spark, path, "m", r, ["a"]).first().a for r in ("r:1", "r:2")]
    assert found == [3.0, 2.0]
    log = str(tmp_path / "log")
    results.append_log(results.parameter_rows(spark, {"iterations": 3}, "m", "r:1"), log)
    results.append_log(results.metric_rows(spark.createDataFrame([(0.5,)], "mse_score double"), "m", "r:1"), log)
    rows = {(r.kind, r.name): r.value for r in results.read_log(spark, log).collect()}
    assert rows == {("parameter", "iterations"): "3", ("parameter", "model_status"): "normal", ("metric", "mse_score"): "0.5"}


def test_csv_keeps_microseconds_and_turns_nan_to_null(spark, tmp_path):
    df = spark.createDataFrame([("u", dt.datetime(2024, 1, 1, 2, 3, 4, 567891), float("nan"))], "k string, t timestamp_ntz, x double")
    path = str(tmp_path / "c")
    tables.write_csv(df, path)
    assert tuple(tables.read_csv(spark, path, df.schema).first()) == ("u", dt.datetime(2024, 1, 1, 2, 3, 4, 567891), None)


def test_catalog_table(spark):
    df = spark.createDataFrame([("u",)], "mapping_uid string")
    df.createOrReplaceTempView("motion_view")
    assert tables.columns_of(tables.table(spark, "motion_view")) == ["mapping_uid"]


def test_workflows(spark, process, tmp_path):
    base, roles = str(tmp_path), {"targets": ("loop_height",), "items": ("loop_height",)}
    motion = process.select("mapping_uid", "equipment_id", "heat_pre")
    qa = process.select("mapping_uid", F.lit("loop_height").alias("measure_item"), F.col("loop_height").alias("value"))
    features = ("equipment_id", "heat_pre")
    refused = workflows.train(qa, motion, base, "m", "r1", features, boosting=FAST, limit=-1.0, **roles)
    assert (refused.accepted, refused.version) == (False, None)
    kept = workflows.train(qa, motion, base, "m", "r1", features, boosting=FAST, **roles)
    again = workflows.retrain(qa, motion, base, "m", "r2", features, boosting=FAST, **roles)
    assert (kept.version, again.version) == (1, 2)
    predictions = workflows.predict(spark, motion, base, "m", "r3", features=features, targets=roles["targets"])
    assert predictions.count() == 300
    metrics, keys = workflows.evaluate(qa, motion, base, "m", "r3", **roles)
    assert metrics.first().mse_score < 20 and keys.first().keys_match
    runs = {r.run_id for r in results.read_log(spark, f"{base}/log").select("run_id").distinct().collect()}
    assert runs == {"r1", "r2", "r3"}


def test_drift_workflow(spark):
    rows = spark.range(200).select(
        F.col("id").cast("string").alias("mapping_uid"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 50).cast("int")).alias("date"),
        F.lit("L").alias("lot_id"),
        F.timestamp_add("MINUTE", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("datetime"),
        F.when(F.col("id") == 199, 9_999).when(F.col("id") >= 150, F.col("id") + 500).otherwise(F.col("id")).cast("double").alias("heat_pre"),
    )
    report = workflows.find_drift(rows, ["2024-01-04"], ["L"])
    assert [(r.column_name, r.drifted) for r in report.columns.collect()] == [("heat_pre", True)]
    assert report.dataset.first().dataset_drifted
    assert report.profile.count() == 2 and report.times.count() == 2
    assert workflows.find_drift(rows, ["2024-01-01"], ["L"]) is None
    assert workflows.find_outliers(rows, "2024-01-04", "L", contamination=0.05).count() == 2


def test_shared_folder_comes_from_the_session(spark):
    assert fresh_path(spark, "x").startswith(shared_folder(spark))
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_rows_of_a_boosting_task_are_bounded(spark, monkeypatch):
    """One large task is dealt out, equal rows too; the rows are the same. A small one stays."""
    monkeypatch.setattr(models, "ROWS_PER_TASK", 100)
    data = spark.range(0, 1000, 1, 1).selectExpr("id % 2 AS a", "id * 0.5D AS b")
    found = models.spread(data)
    sizes = [len(part) for part in found.rdd.glom().collect()]
    assert len(sizes) == 10 and max(sizes) <= 110
    assert sorted(found.collect()) == sorted(data.collect())
    small = spark.range(0, 100, 1, 1)
    assert models.spread(small) is small
