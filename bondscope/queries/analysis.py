"""Outliers, drift and profiles."""

from pyspark.sql import functions as F

from bondscope.operators import drift, lots, outliers, profile
from bondscope.plans import workflows
from bondscope.queries.tables import (
    DRIFT_CUT,
    LINE_KEY,
    LINE_SENSORS,
    current,
    lineitem,
    load,
    reference,
    rounded,
)

# Lots of the analysis workflow: one line status on each of some days.
DAYS = [f"1998-03-{day:02d}" for day in range(1, 21)]
STATUSES = ["O", "F"] * 10


def standardised(spark, sf):
    scaled = outliers.standardised(lineitem(spark, sf), LINE_SENSORS)
    return rounded(scaled.select(*LINE_KEY, *LINE_SENSORS), *LINE_SENSORS)


def _scores(spark, sf, combine):
    scores = outliers.outlier_scores(lineitem(spark, sf), LINE_SENSORS, LINE_KEY, combine)
    return rounded(scores.drop(outliers.ROW, "copies"), "score")


def outlier_scores(spark, sf):
    return _scores(spark, sf, "feature")


def outlier_scores_by_row(spark, sf):
    return _scores(spark, sf, "row")


def outlier_threshold(spark, sf):
    scores = outliers.outlier_scores(lineitem(spark, sf), LINE_SENSORS, LINE_KEY)
    threshold = outliers.outlier_threshold(scores)
    marks = outliers.flagged(scores, threshold)
    report = marks.agg(F.count("*").alias("rows"), F.count_if("outlier").alias("outliers"))
    return rounded(report.withColumn("threshold", threshold.scalar()), "threshold")


def outlier_rows(spark, sf):
    return outliers.outliers(lineitem(spark, sf), LINE_SENSORS, LINE_KEY)


def outliers_of_repeated_lots(spark, sf):
    """A lot that is given twice has its rows twice, in the scores and in the threshold."""
    rows = lineitem(spark, sf)
    twice = rows.unionAll(rows.where(F.col("l_returnflag") == "R"))
    return outliers.outliers(twice, LINE_SENSORS, LINE_KEY)


def column_drift(spark, sf):
    report = drift.column_drift(reference(spark, sf), current(spark, sf), LINE_SENSORS)
    return rounded(report, "distance", "normed_distance")


def drift_between_lots(spark, sf):
    rows = lineitem(spark, sf)
    flagged = rows.where(F.col("l_returnflag") == "R"), rows.where(F.col("l_quantity") > 10)
    return rounded(drift.column_drift(*flagged, LINE_SENSORS), "distance", "normed_distance")


def dataset_drift(spark, sf):
    rows = lineitem(spark, sf)
    report = drift.column_drift(
        rows.where(F.col("l_returnflag") == "R"), rows.where(F.col("l_quantity") > 10), LINE_SENSORS
    )
    return drift.dataset_drift(report)


PROFILE_NUMBERS = (
    "missing_share", "distinct_share", "mean", "std", "q25", "median", "q75", "most_common_share",
)


def column_profile(spark, sf):
    both = profile.profile_both(reference(spark, sf), current(spark, sf), LINE_SENSORS)
    return rounded(both, *PROFILE_NUMBERS)


def time_profile(spark, sf):
    return lots.union_of(
        profile.time_profile(reference(spark, sf), "l_shipdate"),
        profile.time_profile(current(spark, sf), "l_shipdate"),
    )


def dataset_summary(spark, sf):
    rows = load(spark, sf, "lineitem").withColumns(
        {
            "l_tax": F.when(F.col("l_linestatus") == "O", F.col("l_tax")),
            "l_discount": F.when(F.col("l_returnflag") == "R", float("nan")).otherwise(
                F.col("l_discount")
            ),
            "site": F.lit("A"),
        }
    )
    return profile.dataset_summary(rows)


def _dated(spark, sf):
    return lineitem(spark, sf).withColumns(
        {"date": F.to_date("l_shipdate"), "lot_id": F.col("l_linestatus")}
    )


def analysis_outliers(spark, sf):
    return workflows.find_outliers(_dated(spark, sf), DAYS, STATUSES, LINE_SENSORS, LINE_KEY)


def analysis_drift(spark, sf):
    report = workflows.find_drift(
        _dated(spark, sf), DAYS, STATUSES, LINE_SENSORS, LINE_KEY,
        time_column="l_shipdate", reference_rows=15_000,
    )
    return rounded(report.columns, "distance", "normed_distance")


QUERIES = {
    f.__name__: f
    for f in (
        standardised, outlier_scores, outlier_scores_by_row, outlier_threshold, outlier_rows,
        outliers_of_repeated_lots,
        column_drift, drift_between_lots, dataset_drift, column_profile, time_profile,
        dataset_summary, analysis_outliers, analysis_drift,
    )
}

_LINES = "(SELECT *, l_extendedprice AS price_key FROM lineitem)"
_REFERENCE = f"(SELECT * FROM {_LINES} WHERE l_shipdate < TIMESTAMP '{DRIFT_CUT}')"
_CURRENT = f"(SELECT * FROM {_LINES} WHERE l_shipdate >= TIMESTAMP '{DRIFT_CUT}')"
_RETURNED = f"(SELECT * FROM {_LINES} WHERE l_returnflag = 'R')"
_LARGE = f"(SELECT * FROM {_LINES} WHERE l_quantity > 10)"
_DATED = f"(SELECT *, CAST(l_shipdate AS DATE) AS date, l_linestatus AS lot_id FROM {_LINES})"
_CHOSEN = " OR ".join(f"(date = DATE '{d}' AND lot_id = '{s}')" for d, s in zip(DAYS, STATUSES))
_ANALYSED = f"(SELECT * FROM {_DATED} WHERE {_CHOSEN})"
_EARLIER = f"""(SELECT * FROM {_DATED} WHERE date < DATE '{DAYS[0]}'
    ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, price_key LIMIT 15000)"""


def _scored(source: str, combine: str = "feature") -> str:
    """Rows of the source with their score."""
    tails = ", ".join(
        f"CAST(round(-ln(cume_dist() OVER (ORDER BY {c})) * 1e12) AS BIGINT) AS left_{i}, "
        f"CAST(round(-ln(cume_dist() OVER (ORDER BY {c} DESC)) * 1e12) AS BIGINT) AS right_{i}, "
        f"sign((SELECT skewness({c}) FROM {source})) AS sign_{i}"
        for i, c in enumerate(LINE_SENSORS)
    )
    columns = range(len(LINE_SENSORS))
    if combine == "feature":
        score = " + ".join(
            f"greatest(left_{i}, right_{i}, CASE WHEN sign_{i} = 0 THEN left_{i} + right_{i} ELSE 0 END)"
            for i in columns
        )
    else:
        left = " + ".join(f"left_{i}" for i in columns)
        right = " + ".join(f"right_{i}" for i in columns)
        auto = " + ".join(f"CASE WHEN sign_{i} < 0 THEN left_{i} ELSE right_{i} END" for i in columns)
        score = f"greatest({left}, {right}, {auto})"
    return f"(SELECT *, ({score}) / 1e12 AS score FROM (SELECT *, {tails} FROM {source}))"


def _outliers(source: str, columns: str) -> str:
    scored = _scored(source)
    return f"""
        WITH scored AS (SELECT * FROM {scored})
        SELECT {columns} FROM scored
        WHERE score > (SELECT quantile_cont(score, 0.999) FROM scored)"""


def _drift(reference_sql: str, current_sql: str) -> str:
    parts = []
    for c in LINE_SENSORS:
        parts.append(f"""
            SELECT '{c}' AS column_name, sum(area) AS distance,
                   sum(area) / greatest((SELECT stddev_pop({c}) FROM {reference_sql}), 0.001)
                       AS normed_distance
            FROM (
                SELECT coalesce(abs(sum(r) OVER w / (SELECT count(*) FROM {reference_sql})
                         - sum(k) OVER w / (SELECT count(*) FROM {current_sql}))
                       * (lead(x) OVER (ORDER BY x) - x), 0) AS area
                FROM (SELECT x, sum(r)::DOUBLE AS r, sum(k)::DOUBLE AS k FROM (
                    SELECT {c} AS x, 1 AS r, 0 AS k FROM {reference_sql}
                    UNION ALL SELECT {c}, 0, 1 FROM {current_sql}) GROUP BY x)
                WINDOW w AS (ORDER BY x ROWS UNBOUNDED PRECEDING))""")
    return f"""
        SELECT column_name, round(distance, 6) AS distance,
               round(normed_distance, 6) AS normed_distance, CAST(0.1 AS DOUBLE) AS threshold,
               normed_distance >= 0.1 AS drifted
        FROM ({' UNION ALL '.join(parts)})"""


def _profile() -> str:
    parts = []
    for side, source in (("reference", _REFERENCE), ("current", _CURRENT)):
        for c in LINE_SENSORS:
            parts.append(f"""
                SELECT '{side}' AS side, '{c}' AS column_name, count({c}) AS value_count,
                    count(*) - count({c}) AS missing_count,
                    round((count(*) - count({c})) / count(*), 6) AS missing_share,
                    count(DISTINCT {c}) AS distinct_count,
                    round(count(DISTINCT {c}) / count(*), 6) AS distinct_share,
                    round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
                    min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q25,
                    round(median({c}), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q75,
                    max({c}) AS max,
                    (SELECT {c} FROM {source} GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)
                        AS most_common,
                    round((SELECT count(*) FROM {source} GROUP BY {c} ORDER BY count(*) DESC LIMIT 1)
                        / count(*), 6) AS most_common_share,
                    count(*) FILTER (WHERE isinf({c})) AS infinite_count
                FROM {source}""")
    return " UNION ALL ".join(parts)


_SCALED = ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem), 6) AS {c}"
    for c in LINE_SENSORS
)
_KEY = ", ".join(LINE_KEY)
_COLUMNS = """l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
    l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, price_key"""

ORACLE = {
    "standardised": f"SELECT {_KEY}, {_SCALED} FROM {_LINES}",
    "outlier_scores": f"SELECT {_KEY}, round(score, 6) AS score FROM {_scored(_LINES)}",
    "outlier_scores_by_row": f"SELECT {_KEY}, round(score, 6) AS score FROM {_scored(_LINES, 'row')}",
    "outlier_threshold": f"""
        WITH scored AS (SELECT score FROM {_scored(_LINES)})
        SELECT count(*) AS rows,
               count(*) FILTER (WHERE score > (SELECT quantile_cont(score, 0.999) FROM scored)) AS outliers,
               round((SELECT quantile_cont(score, 0.999) FROM scored), 6) AS threshold
        FROM scored""",
    "outlier_rows": _outliers(_LINES, _COLUMNS),
    "outliers_of_repeated_lots": _outliers(f"(SELECT * FROM {_LINES} UNION ALL SELECT * FROM {_RETURNED})", _COLUMNS),
    "column_drift": _drift(_REFERENCE, _CURRENT),
    "drift_between_lots": _drift(_RETURNED, _LARGE),
    "dataset_drift": f"""
        SELECT *, drifted_columns / column_count AS drifted_share,
               drifted_columns / column_count >= 0.5 AS dataset_drifted
        FROM (SELECT count(*) AS column_count, count(*) FILTER (WHERE drifted) AS drifted_columns
              FROM ({_drift(_RETURNED, _LARGE)}))""",
    "column_profile": _profile(),
    "time_profile": " UNION ALL ".join(
        f"""SELECT 'l_shipdate' AS column_name, min(l_shipdate) AS min, max(l_shipdate) AS max,
                   count(*) - count(l_shipdate) AS missing_count FROM {source}"""
        for source in (_REFERENCE, _CURRENT)
    ),
    "dataset_summary": """
        SELECT count(*) AS row_count, 12 AS column_count,
               CAST(sum(CAST(l_linestatus <> 'O' AS INT) + CAST(l_returnflag = 'R' AS INT)) AS BIGINT)
                   AS missing_cells,
               count(*) FILTER (WHERE l_linestatus <> 'O' OR l_returnflag = 'R') AS rows_with_missing,
               1 AS constant_columns
        FROM lineitem""",
    "analysis_outliers": _outliers(_ANALYSED, f"{_COLUMNS}, date, lot_id"),
    "analysis_drift": _drift(_EARLIER, _ANALYSED),
}
