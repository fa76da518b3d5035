"""Symmetric-tree models and ordered statistics, with check SQL that fits the same trees."""

from dataclasses import dataclass

from pyspark.sql import functions as F

from bondscope.operators import boosting
from bondscope.operators.statistics import (
    category_table, hash_order, ordered_statistics, priors, with_statistics,
)
from bondscope.queries.tables import ITEMS, LINE_KEY, lineitem, load, rounded
from bondscope.storage import fresh_path

# Full depth; each round is depth passes over all rows, so the check takes few rounds.
SETTINGS = boosting.Symmetric(iterations=2, bins=32)
# All rounds and bins; the check SQL loops over its rounds.
WHOLE = boosting.Symmetric()
LINE_FEATURES = ("l_extendedprice", "l_discount", "l_partkey")
LINE_TARGETS = ("l_quantity", "l_tax")
EVENT_FEATURES = ("value", "user_id")
STATISTICS_KEY = ("l_orderkey", "l_linenumber")


def symmetric_regression(spark, sf):
    rows = lineitem(spark, sf)
    model = boosting.fit(rows, LINE_FEATURES, LINE_TARGETS, SETTINGS, LINE_KEY, classify=False)
    return rounded(boosting.score(model, rows, LINE_KEY), *LINE_TARGETS, digits=3)


def continued_regression(spark, sf):
    """One round, stored, loaded and continued by one more: the same as two rounds at once."""
    rows, path = lineitem(spark, sf), fresh_path(spark, "boosting-model")
    first = boosting.Symmetric(iterations=1, bins=SETTINGS.bins)
    boosting.save(boosting.fit(rows, LINE_FEATURES, LINE_TARGETS, first, LINE_KEY, classify=False), spark, path)
    model = boosting.extend(boosting.load(spark, path), rows, 1, LINE_KEY)
    return rounded(boosting.score(model, rows, LINE_KEY), *LINE_TARGETS, digits=3)


def _classed(spark, sf):
    kinds = F.array(*[F.lit(i) for i in ITEMS])
    return load(spark, sf, "events").withColumns({
        "kind": (F.array_position(kinds, F.col("event_type")) - 1).cast("int"),
        "large": (F.col("value") > 10).cast("int")})


def softmax_classes(spark, sf):
    """Five classes and two classes, each one model with a gradient for every class."""
    rows = _classed(spark, sf)
    model = boosting.fit(rows, EVENT_FEATURES, ("kind", "large"), WHOLE, ("event_id",))
    scored = boosting.score(model, rows, ["event_id"], chances=True)
    return scored.select("event_id", *[F.round(F.get(f"{t}_chances", F.lit(k)), 4).alias(f"{t}_{k}")
                                       for t, n in (("kind", len(ITEMS)), ("large", 2)) for k in range(n)])


def ordered_target_statistics(spark, sf):
    rows = lineitem(spark, sf).select(*STATISTICS_KEY, "l_returnflag", "l_quantity")
    prior = priors(rows, ["l_quantity"])
    out = ordered_statistics(rows, ["l_returnflag"], ["l_quantity"], hash_order(STATISTICS_KEY), prior, digits=1)
    return out.select(*STATISTICS_KEY, "l_quantity", F.floor(F.col("l_returnflag__l_quantity") * 1e6).alias("millionths"))


def category_means(spark, sf):
    """Statistics of one half of the orders' lines on all lines: unseen suppliers get the prior."""
    rows = lineitem(spark, sf).select("l_orderkey", F.col("l_suppkey").cast("string").alias("supplier"), "l_quantity")
    train = rows.where("l_orderkey % 2 = 0")
    table = category_table(train, ["supplier"], ["l_quantity"])
    out = with_statistics(rows, table, ["supplier"], ["l_quantity"], priors(train, ["l_quantity"]))
    return out.groupBy("supplier").agg(
        F.count("*").alias("rows"), F.round(F.max("supplier__l_quantity"), 6).alias("mean_of_train"))


@dataclass(frozen=True)
class Fitted:
    """Names in the check SQL: source, key, columns of the source, and the targets with their classes (0: a number)."""

    source: str
    key: tuple[str, ...]
    inputs: int
    targets: tuple[int, ...]

    @property
    def outputs(self) -> list[tuple[int, int]]:
        return [(t, k) for t, classes in enumerate(self.targets) for k in range(max(1, classes))]


def _bins_sql(fitted: Fitted, bins: int) -> list[str]:
    parts = [f"d AS MATERIALIZED ({fitted.source})"]
    for f in range(fitted.inputs):
        parts.append(f"""cuts{f} AS (SELECT next_x AS cut FROM (
  SELECT x, n, n_le, lead(x) OVER (ORDER BY x) AS next_x, sum(n) OVER () AS total
  FROM (SELECT x, n, sum(n) OVER (ORDER BY x) AS n_le FROM (SELECT x{f} AS x, count(*) AS n FROM d GROUP BY 1)))
  WHERE next_x IS NOT NULL AND floor(n_le * {bins} / total) > floor((n_le - n) * {bins} / total)),
bins{f} AS (SELECT x, count(cut) AS bin FROM (SELECT DISTINCT x{f} AS x FROM d) LEFT JOIN cuts{f} ON cut <= x GROUP BY x)""")
    joins = " ".join(f"JOIN bins{f} ON bins{f}.x = d.x{f}" for f in range(fitted.inputs))
    scores = ", ".join(
        f"{0 if fitted.targets[t] else f'(SELECT avg(y{t}) FROM d)'}::DOUBLE AS s{t}_{k}" for t, k in fitted.outputs)
    bins_of = ", ".join(f"bins{f}.bin" for f in range(fitted.inputs))
    parts.append(f"s0 AS MATERIALIZED (SELECT d.*, [{bins_of}] AS bins, {scores} FROM d {joins})")
    return parts


def _gradient_sql(fitted: Fitted, t: int, k: int) -> tuple[str, str]:
    classes = fitted.targets[t]
    if not classes:
        return f"y{t} - s{t}_0", "1.0"
    most = "greatest(" + ", ".join(f"s{t}_{j}" for j in range(classes)) + ")"
    whole = " + ".join(f"exp(s{t}_{j} - {most})" for j in range(classes))
    p = f"(exp(s{t}_{k} - {most}) / ({whole}))"
    return f"CASE WHEN y{t} = {k} THEN 1.0 ELSE 0.0 END - {p}", f"{p} * (1 - {p})"


def _round_sql(fitted: Fitted, r: int, settings: boosting.Symmetric) -> list[str]:
    l2, tie, count = settings.l2, 1 - boosting.TIE, len(fitted.targets)
    slopes = ", ".join("{} AS g{t}_{k}, {} AS h{t}_{k}".format(*_gradient_sql(fitted, t, k), t=t, k=k) for t, k in fitted.outputs)
    leaves = ", ".join(f"0 AS leaf{t}" for t in range(count))
    parts = [f"v{r}_0 AS MATERIALIZED (SELECT *, {slopes}, {leaves} FROM s{r})"]
    for level in range(settings.depth):
        at = f"{r}_{level}"
        cells = " UNION ALL ".join(
            f"SELECT {t} AS t, {k} AS o, leaf{t} AS leaf, {f} AS f, bins[{f + 1}] AS bin, g{t}_{k} AS g FROM v{at}"
            for t, k in fitted.outputs for f in range(fitted.inputs))
        found = ", ".join(f"(SELECT f, b FROM pick{at} WHERE t = {t}) AS p{t}" for t in range(count))
        moved = ", ".join(f"leaf{t} + CASE WHEN bins[p{t}.f + 1] >= p{t}.b THEN {1 << level} ELSE 0 END AS leaf{t}" for t in range(count))
        parts.append(f"""sums{at} AS MATERIALIZED (SELECT t, o, leaf, f, bin, count(*) AS n, sum(g) AS g FROM ({cells}) GROUP BY ALL),
sides{at} AS (SELECT t, f, b, leaf, o, sum(n) AS n, sum(g) AS g, coalesce(sum(n) FILTER (bin < b), 0) AS n_left,
  coalesce(sum(g) FILTER (bin < b), 0) AS g_left FROM sums{at}, range(1, {settings.bins}) AS c(b) GROUP BY ALL),
gain{at} AS (SELECT t, f, b, sum(g_left * g_left / (n_left + {l2}) + (g - g_left) * (g - g_left) / (n - n_left + {l2})) AS gain
  FROM sides{at} GROUP BY ALL),
best{at} AS (SELECT t, f, min(b) AS b, arg_min(gain, b) AS gain
  FROM (SELECT *, max(gain) OVER (PARTITION BY t, f) AS most FROM gain{at}) WHERE gain >= most * {tie} GROUP BY ALL),
pick{at} AS MATERIALIZED (SELECT t, min(f) AS f, arg_min(b, f) AS b
  FROM (SELECT *, max(gain) OVER (PARTITION BY t) AS most FROM best{at}) WHERE gain >= most * {tie} GROUP BY t),
v{r}_{level + 1} AS MATERIALIZED (SELECT v.* REPLACE ({moved}) FROM v{at} AS v, {found})""")
    last = f"v{r}_{settings.depth}"
    for t, k in fitted.outputs:
        parts.append(f"value{r}_{t}_{k} AS (SELECT leaf{t} AS leaf, {settings.learning_rate} * sum(g{t}_{k}) / (sum(h{t}_{k}) + {l2}) AS v "
                     f"FROM {last} GROUP BY 1)")
    gone = ", ".join(f"g{t}_{k}, h{t}_{k}" for t, k in fitted.outputs) + ", " + ", ".join(f"leaf{t}" for t in range(count))
    added = ", ".join(f"s{t}_{k} + w{t}_{k}.v AS s{t}_{k}" for t, k in fitted.outputs)
    joins = " ".join(f"JOIN value{r}_{t}_{k} AS w{t}_{k} ON w{t}_{k}.leaf = u.leaf{t}" for t, k in fitted.outputs)
    parts.append(f"s{r + 1} AS MATERIALIZED (SELECT u.* EXCLUDE ({gone}) REPLACE ({added}) FROM {last} AS u {joins})")
    return parts


def trees_sql(fitted: Fitted, settings: boosting.Symmetric, select: str) -> str:
    """SQL that fits symmetric trees to ``fitted`` and then selects from ``final``."""
    parts = _bins_sql(fitted, settings.bins)
    for r in range(settings.iterations):
        parts += _round_sql(fitted, r, settings)
    return "WITH " + ",\n".join(parts) + f",\nfinal AS (SELECT * FROM s{settings.iterations})\n{select}"


def _level_sql(fitted: Fitted, level: int, settings: boosting.Symmetric) -> list[str]:
    """One level of the trees of all targets. A row of sums has a column for each output of its target.

    Between the bins that a leaf has, its gain stays the same: changes of the gain are added up along the cuts.
    """
    l2, tie, count = settings.l2, 1 - boosting.TIE, len(fitted.targets)
    ks = range(max(max(1, classes) for classes in fitted.targets))
    cells = " UNION ALL ".join(
        f"SELECT {t} AS t, leaf{t} AS leaf, {f} AS f, bins[{f + 1}] AS bin, "
        + ", ".join(f"g{t}_{k} AS g{k}" if k < max(1, classes) else f"0.0 AS g{k}" for k in ks) + f" FROM v{level}"
        for t, classes in enumerate(fitted.targets) for f in range(fitted.inputs))
    squares = lambda g, n: "(" + " + ".join(f"({g}) ** 2".format(k=k) for k in ks) + f") / ({n} + {l2})"
    after = squares("l{k}", "ln") + " + " + squares("w{k} - l{k}", "wn - ln")
    before = squares("l{k} - g{k}", "ln - n") + " + " + squares("w{k} - l{k} + g{k}", "wn - ln + n")
    sums = ", ".join(f"sum(g{k}) AS g{k}" for k in ks)
    upto = ", ".join(f"sum(g{k}) OVER upto AS l{k}, sum(g{k}) OVER every AS w{k}" for k in ks)
    found = ", ".join(f"(SELECT f, b FROM pick{level} WHERE t = {t}) AS p{t}" for t in range(count))
    moved = ", ".join(f"leaf{t} + CASE WHEN bins[p{t}.f + 1] >= p{t}.b THEN {1 << level} ELSE 0 END AS leaf{t}" for t in range(count))
    return [f"""sums{level} AS (SELECT t, leaf, f, bin, count(*) AS n, {sums} FROM ({cells}) GROUP BY ALL),
sides{level} AS (SELECT *, sum(n) OVER upto AS ln, sum(n) OVER every AS wn, {upto} FROM sums{level}
  WINDOW upto AS (PARTITION BY t, f, leaf ORDER BY bin), every AS (PARTITION BY t, f, leaf)),
more{level} AS (SELECT t, f, bin + 1 AS b, sum({after} - ({before})) AS more,
  sum(CASE WHEN ln = n THEN {squares("w{k}", "wn")} ELSE 0 END) AS start FROM sides{level} GROUP BY ALL),
gain{level} AS (SELECT t, f, b, sum(start) OVER (PARTITION BY t, f) + sum(more) OVER (PARTITION BY t, f ORDER BY b) AS gain FROM more{level}),
best{level} AS (SELECT t, f, min(b) AS b, arg_min(gain, b) AS gain
  FROM (SELECT *, max(gain) OVER (PARTITION BY t, f) AS most FROM gain{level} WHERE b < {settings.bins}) WHERE gain >= most * {tie} GROUP BY ALL),
pick{level} AS MATERIALIZED (SELECT t, min(f) AS f, arg_min(b, f) AS b
  FROM (SELECT *, max(gain) OVER (PARTITION BY t) AS most FROM best{level}) WHERE gain >= most * {tie} GROUP BY t),
v{level + 1} AS MATERIALIZED (SELECT v.* REPLACE ({moved}) FROM v{level} AS v, {found})"""]


def looped_sql(fitted: Fitted, settings: boosting.Symmetric, select: str) -> str:
    """The trees of ``trees_sql`` for any number of rounds: a recursion that keeps the last scores of each key."""
    count, outputs = len(fitted.targets), fitted.outputs
    slopes = ", ".join("{} AS g{t}_{k}, {} AS h{t}_{k}".format(*_gradient_sql(fitted, t, k), t=t, k=k) for t, k in outputs)
    leaves = ", ".join(f"0 AS leaf{t}" for t in range(count))
    steps = [f"v0 AS MATERIALIZED (SELECT *, {slopes}, {leaves} FROM rounds WHERE round < {settings.iterations})"]
    for level in range(settings.depth):
        steps += _level_sql(fitted, level, settings)
    last = f"v{settings.depth}"
    for t in range(count):
        values = ", ".join(f"{settings.learning_rate} * sum(g{s}_{k}) / (sum(h{s}_{k}) + {settings.l2}) AS w{s}_{k}"
                           for s, k in outputs if s == t)
        steps.append(f"value{t} AS (SELECT leaf{t} AS leaf, {values} FROM {last} GROUP BY 1)")
    key, truths = ", ".join(fitted.key), ", ".join(f"y{t}" for t in range(count))
    scores, added = (", ".join(x.format(t=t, k=k) for t, k in outputs) for x in ("s{t}_{k}", "s{t}_{k} + w{t}_{k}"))
    joins = " ".join(f"JOIN value{t} ON value{t}.leaf = u.leaf{t}" for t in range(count))
    loop = f"""rounds(round, {key}, bins, {truths}, {scores}) USING KEY ({key}) AS (
SELECT 0, {key}, bins, {truths}, {scores} FROM s0
UNION SELECT * FROM (WITH {", ".join(steps)}
SELECT round + 1, {key}, bins, {truths}, {added} FROM {last} AS u {joins}))"""
    parts = [*_bins_sql(fitted, settings.bins), loop, "final AS (SELECT * FROM rounds)"]
    return "WITH RECURSIVE " + ",\n".join(parts) + f"\n{select}"


LINES = Fitted(
    "SELECT l_orderkey, l_linenumber, l_extendedprice AS price_key, l_extendedprice::DOUBLE AS x0, l_discount::DOUBLE AS x1, "
    "l_partkey::DOUBLE AS x2, l_quantity::DOUBLE AS y0, l_tax::DOUBLE AS y1 FROM lineitem",
    LINE_KEY, 3, (0, 0))
EVENTS = Fitted(
    "SELECT event_id, value::DOUBLE AS x0, user_id::DOUBLE AS x1, list_position(["
    + ", ".join(f"'{i}'" for i in ITEMS) + "], event_type) - 1 AS y0, CASE WHEN value > 10 THEN 1 ELSE 0 END AS y1 FROM events",
    ("event_id",), 2, (len(ITEMS), 2))


def _chance_sql(t: int, name: str, classes: int) -> str:
    whole = " + ".join(f"exp(s{t}_{j})" for j in range(classes))
    return ", ".join(f"round(exp(s{t}_{k}) / ({whole}), 4) AS {name}_{k}" for k in range(classes))


REGRESSION_SQL = trees_sql(LINES, SETTINGS, (
    "SELECT l_orderkey, l_linenumber, price_key, round(s0_0, 3) AS l_quantity, round(s1_0, 3) AS l_tax FROM final"))

QUERIES = {f.__name__: f for f in (
    symmetric_regression, continued_regression, softmax_classes, ordered_target_statistics, category_means)}

ORACLE = {
    "symmetric_regression": REGRESSION_SQL,
    "continued_regression": REGRESSION_SQL,
    "softmax_classes": looped_sql(EVENTS, WHOLE, (
        f"SELECT event_id, {_chance_sql(0, 'kind', len(ITEMS))}, {_chance_sql(1, 'large', 2)} FROM final")),
    "ordered_target_statistics": """
WITH r AS (SELECT *, md5(concat_ws('|', l_orderkey, l_linenumber)) AS o FROM lineitem),
w AS (SELECT *, sum(l_quantity) OVER upto - sum(l_quantity) OVER peers AS total, count(*) OVER upto - count(*) OVER peers AS n
  FROM r WINDOW upto AS (PARTITION BY l_returnflag ORDER BY o RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    peers AS (PARTITION BY l_returnflag, o))
SELECT l_orderkey, l_linenumber, l_quantity,
  floor((total + (SELECT avg(l_quantity) FROM lineitem)) / (n + 1) * 1e6)::BIGINT AS millionths FROM w""",
    "category_means": """
WITH train AS (SELECT * FROM lineitem WHERE l_orderkey % 2 = 0),
prior AS (SELECT avg(l_quantity) AS p FROM train),
known AS (SELECT l_suppkey, sum(l_quantity) AS total, count(*) AS n FROM train GROUP BY 1)
SELECT l_suppkey::VARCHAR AS supplier, count(*) AS rows,
  round(max((coalesce(total, 0) + p) / (coalesce(n, 0) + 1)), 6) AS mean_of_train
FROM lineitem LEFT JOIN known USING (l_suppkey), prior GROUP BY 1""",
}
