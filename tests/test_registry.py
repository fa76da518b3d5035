"""Versions beside other writers, continued training and saved classes through the workflows."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from bondscope.operators import boosting, models
from bondscope.plans import workflows
from bondscope.sources import registry, synthetic

QUICK = boosting.Symmetric(iterations=2, depth=2, bins=8)


def test_writers_in_threads_get_their_own_versions(spark, tmp_path):
    base = str(tmp_path)

    def write(i):
        return registry.publish(
            spark, base, "m", lambda path: spark.range(i + 1).write.parquet(path), writer=i), i

    with ThreadPoolExecutor(8) as pool:
        found = dict(pool.map(write, range(8)))
    assert sorted(found) == registry.versions(spark, base, "m") == list(range(1, 9))
    for version, i in found.items():
        assert registry.facts(spark, base, "m", version) == {"writer": i}
        assert spark.read.parquet(registry.version_path(base, "m", version)).count() == i + 1


def test_a_broken_write_is_not_listed(spark, tmp_path):
    base = str(tmp_path)

    def broken(path):
        spark.range(3).write.parquet(path)
        raise OSError("lost")

    with pytest.raises(OSError):
        registry.publish(spark, base, "m", broken)
    assert registry.versions(spark, base, "m") == []
    assert registry.publish(spark, base, "m", lambda path: None) == 2
    with pytest.raises(ValueError, match="no version"):
        models.load_model(spark, base, "m", 1)


@pytest.fixture(scope="module")
def process(spark):
    made = synthetic.process_table(spark, 300)
    return made.withColumn("mapping_uid", F.date_format("proc_datetime", "yyyyMMddHHmm")).cache()


def lots(process):
    motion = process.select("mapping_uid", "equipment_id", "heat_pre", F.lit("2024-01-01").alias("date"),
                            F.when(F.col("heat_pre") > 150, "L2").otherwise("L1").alias("lot_id"))
    qa = motion.select("mapping_uid", "date", "lot_id", F.explode(F.array(
        F.struct(F.lit("loop_height").alias("measure_item"), (F.col("heat_pre") / 10).alias("value")),
        F.struct(F.lit("ball_shear").alias("measure_item"), (-F.col("heat_pre")).alias("value")))).alias("m"))
    return qa.select("mapping_uid", "date", "lot_id", "m.*"), motion


def test_workflows_go_on_from_a_version_and_choose_lots(spark, process, tmp_path):
    qa, motion = lots(process)
    base, roles = str(tmp_path), {"targets": ("loop_height", "ball_shear"), "items": ("loop_height", "ball_shear")}
    features, lot = ("equipment_id", "heat_pre"), {"dates": ["2024-01-01"], "lot_ids": ["L1"]}
    first = workflows.train(qa, motion, base, "m", "r1", features, boosting=QUICK, limit=1e9, **roles, **lot)
    again = workflows.retrain(qa, motion, base, "m", "r2", features, boosting=replace(QUICK, iterations=3), limit=1e9, **roles, **lot)
    assert (first.version, again.version) == (1, 2)
    assert registry.facts(spark, f"{base}/models", "m", 2) == {"kind": "symmetric", "parent": 1}
    assert [len(t) for t in again.model.trees] == [5, 5]
    assert again.model.trees[0][:2] == first.model.trees[0]
    assert again.metrics.first().mse_score < first.metrics.first().mse_score
    scored = workflows.predict(spark, motion, base, "m", "r3", features=features, targets=roles["targets"], **lot)
    wanted = motion.where("lot_id = 'L1'").count()
    assert 0 < wanted < motion.count() and scored.count() == wanted
    _, keys = workflows.evaluate(qa, motion, base, "m", "r3", **roles, **lot)
    assert keys.first().keys_match


@pytest.mark.parametrize("settings", [replace(QUICK, bins=254), models.Boosting(2, 0.1, 2)])
def test_saved_classes_score_through_the_workflow(spark, process, tmp_path, settings):
    """Three and two classes, saved, loaded and scored by predict."""
    rows = process.withColumns({
        "kind": F.when(F.col("heat_pre") > 160, 7).when(F.col("heat_pre") > 130, 5).otherwise(2),
        "hot": F.when(F.col("heat_pre") > 150, 4).otherwise(3)})
    model = models.fit(rows, ["heat_pre"], ["kind", "hot"], settings, key=["mapping_uid"])
    models.save_model(model, spark, f"{tmp_path}/models", "c")
    found = workflows.predict(spark, rows, str(tmp_path), "c", "r", features=["heat_pre"], targets=["kind", "hot"])
    found = found.toDF("mapping_uid", "k", "h").join(rows, "mapping_uid")
    assert found.where("k = kind AND h = hot").count() > 285
    assert {r.k for r in found.collect()} == {2, 5, 7}
