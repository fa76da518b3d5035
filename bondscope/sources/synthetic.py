"""A synthetic process table for demonstrations and tests."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Mean and deviation of the normal columns, bounds of the uniform ones.
NORMAL = {
    "al_squeeze_out_x": (10, 2),
    "al_squeeze_out_y": (15, 3),
    "outer_ball_size_x": (50, 5),
    "outer_ball_size_y": (55, 6),
    "ball_thickness": (20, 2),
    "loop_height": (30, 3),
}
UNIFORM = {
    "heat_pre": (100, 200),
    "outer_ball_shape": (0.8, 1.2),
    "inner_ball_shape": (0.9, 1.1),
}


def process_table(spark: SparkSession, rows: int = 200, seed: int = 42) -> DataFrame:
    """One row per minute from 2024-01-01 with random equipment, lead frame and sensor values."""

    def code(prefix: str, count: int, offset: int):
        number = F.floor(F.rand(seed + offset) * count) + 1
        return F.concat(F.lit(prefix), F.lpad(number.cast("string"), 3, "0"))

    start = F.lit("2024-01-01").cast("timestamp_ntz")
    columns = [
        code("EQ", 5, 0).alias("equipment_id"),
        code("LF", 3, 1).alias("lf_id"),
        F.timestamp_add("MINUTE", F.col("id").cast("int"), start).alias("proc_datetime"),
    ]
    for i, (name, (mean, std)) in enumerate(NORMAL.items()):
        columns.append((F.randn(seed + 10 + i) * std + mean).alias(name))
    for i, (name, (low, high)) in enumerate(UNIFORM.items()):
        columns.append((F.rand(seed + 20 + i) * (high - low) + low).alias(name))
    return spark.range(rows).select(*columns)
