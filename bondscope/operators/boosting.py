"""Gradient boosting with symmetric trees: every level of a tree asks one question of all its leaves.

Features are cut into bins once, and the rows are kept as blocks: bins, truths and scores in columns. A
level is one pass over the blocks of all targets: every block counts gradient sums by (output, leaf,
feature, bin) in numpy, these are added up for each (target, feature), and the best cut is found from
them; their number does not grow with the rows. Rows that fit one block need no exchange, so one task
grows all their trees. A regression target has one output, a class target one for each class
(softmax). The model is a small table that numpy scores.
"""

import json
import math
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from bondscope.functions.columns import TIME_PARTS, complete_rows, text_columns, time_columns
from bondscope.operators.ranks import chunker, ranked_values
from bondscope.operators.statistics import (
    category_table, encoded_name, hash_order, ordered_statistics, priors, with_statistics,
)
from bondscope.storage import handed_over, removed

# Trees between two stored states; each pass applies only the trees since the last one.
TREES_PER_STATE = 8
# Gains that differ by less than this share count as equal; the first feature and cut wins.
TIE = 1e-9
# Sums of gradients are kept below 2 to this power, in whole numbers.
SUM_BITS = 60
# Bytes of the rows of a block as a pass holds them: the rows of one task.
BLOCK_BYTES = 1 << 26
# Within a block doubles hold the sums, exact for whole numbers below 2 to this power.
BLOCK_SUM_BITS = 52


@dataclass(frozen=True)
class Symmetric:
    """Settings; iterations, rate and depth are the fixed values of the models."""

    iterations: int = 1000
    learning_rate: float = 0.1
    depth: int = 6
    bins: int = 254
    l2: float = 3.0


@dataclass(frozen=True)
class Target:
    """A target column; ``classes`` is None for a number, else the sorted values."""

    name: str
    classes: tuple | None = None
    base: tuple[float, ...] = (0.0,)


@dataclass(frozen=True)
class Tree:
    """Levels (feature, bin) from the first to the last; ``values`` by output, then leaf.

    A row is right at a level if its bin of the feature is at least the given one; the
    levels are the bits of the leaf, the first level the lowest.
    """

    levels: tuple[tuple[int, int], ...]
    values: tuple[tuple[float, ...], ...]


@dataclass
class SymmetricModel:
    """Everything from raw columns to predictions; ``categories`` stays a DataFrame."""

    settings: Symmetric
    features: tuple[str, ...]
    texts: tuple[str, ...]
    times: tuple[str, ...]
    statistics: dict[str, float]
    inputs: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    targets: tuple[Target, ...]
    trees: tuple[tuple[Tree, ...], ...] = field(default_factory=tuple)
    categories: DataFrame | None = None


def _outputs(target: Target) -> int:
    return len(target.base)


def _indicators(target: Target) -> dict[str, Column]:
    """Numbers whose running means describe a text value: the target, or one 0/1 for each class."""
    if target.classes is None:
        return {target.name: F.col(target.name).cast("double")}
    return {f"{target.name}_{c}": (F.col(target.name) == F.lit(c)).cast("double") for c in target.classes}


def _timed(df: DataFrame, times: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{c}_{name}": part(c).cast("double") for c in times for name, part in TIME_PARTS.items()})


def bin_cuts(df: DataFrame, inputs: Sequence[str], bins: int, chunks: int | None = None) -> list[list[float]]:
    """Cuts of each numeric column: at most ``bins`` - 1 values that open a new bin.

    A value opens a bin when the count of smaller values passes a multiple of rows / bins. The
    ranks are exact, so the cuts do not depend on how the rows lie.
    """
    ranked = ranked_values(df, list(inputs), chunker(df, list(inputs), chunks))
    level = lambda n: F.floor(n * F.lit(bins) / F.col("n_total"))
    opened = ranked.where(F.col("next_x").isNotNull() & (level(F.col("n_le")) > level(F.col("n_le") - F.col("n"))))
    found = opened.groupBy("feature").agg(F.array_sort(F.collect_list("next_x")).alias("cuts")).collect()
    cuts = {r.feature: r.cuts for r in found}  # below columns x bins numbers
    return [cuts.get(i, []) for i in range(len(inputs))]


def _bin_type(bins: int) -> type:
    return np.uint8 if bins <= 256 else np.int32


def _bins(columns: Sequence[np.ndarray], model: SymmetricModel) -> np.ndarray:
    """Bins by feature, then row: the number of cuts up to each value."""
    found = [np.searchsorted(np.asarray(cuts, float), x, side="right") for x, cuts in zip(columns, model.cuts)]
    return np.stack(found).astype(_bin_type(model.settings.bins))


def _leaves(bins: np.ndarray, levels: Sequence[tuple[int, int]]) -> np.ndarray:
    leaf = np.zeros(bins.shape[1], np.int64)
    for i, (f, b) in enumerate(levels):
        leaf |= (bins[f] >= b).astype(np.int64) << i
    return leaf


def _added(scores: np.ndarray, bins: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    """The trees added to the scores (output, row) from the left: storing them in between changes no bit."""
    scores = scores.copy()
    for tree in trees:
        leaf = _leaves(bins, tree.levels)
        for k, values in enumerate(tree.values):
            scores[k] += np.asarray(values)[leaf]
    return scores


def _with_gradients(wide: DataFrame, targets: Sequence[Target], scale: Mapping[int, float]) -> DataFrame:
    """Add the negative gradient ``_g`` and curvature ``_h`` of each output, as whole numbers.

    Each step is a projection of its own, so a number that several outputs need is computed
    once for a row: written out, softmax would repeat every exponential for every output.
    The passes do the same in numpy (``_slopes``); a test compares the two.
    """
    scores, first = {}, 0
    for t, target in enumerate(targets):
        scores[t] = [f"_s{first + k}" for k in range(_outputs(target))]
        first += _outputs(target)
    classed = [t for t, target in enumerate(targets) if target.classes is not None]
    each = [(t, k, s[2:]) for t in classed for k, s in enumerate(scores[t])]
    if classed:
        wide = wide.select("*", *[F.array_max(F.array(*scores[t])).alias(f"_most{t}") for t in classed])
        wide = wide.select("*", *[F.exp(F.col(f"_s{i}") - F.col(f"_most{t}")).alias(f"_e{i}") for t, _, i in each])
        sums = {t: [F.col("_e" + s[2:]) for s in scores[t]] for t in classed}
        wide = wide.select("*", *[sum(sums[t][1:], sums[t][0]).alias(f"_whole{t}") for t in classed])
        wide = wide.select("*", *[(F.col(f"_e{i}") / F.col(f"_whole{t}")).alias(f"_p{i}") for t, _, i in each])
    rounded = lambda c, t: F.round(c * F.lit(scale[t])).cast("long")
    made = []
    for t, target in enumerate(targets):
        for k, s in enumerate(scores[t]):
            truth, p = F.col(f"_y{t}"), F.col("_p" + s[2:])
            g, h = (truth - F.col(s), F.lit(1.0)) if target.classes is None else ((truth == k).cast("double") - p, p * (1 - p))
            made += [rounded(g, t).alias("_g" + s[2:]), rounded(h, t).alias("_h" + s[2:])]
    return wide.select("_bins", *made)


@dataclass
class Block:
    """Rows as columns: bins by feature, truths by target, scores by target and output."""

    bins: np.ndarray
    truths: np.ndarray
    scores: list[np.ndarray]

    def moved(self, trees: Sequence[Sequence[Tree]]) -> "Block":
        return replace(self, scores=[_added(s, self.bins, x) for s, x in zip(self.scores, trees)])


def _slopes(target: Target, truth: np.ndarray, scores: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray | None]:
    """Negative gradient and curvature by output as whole doubles; None for the curvature of a number, always 1."""
    if target.classes is None:
        return np.rint((truth - scores) * scale), None
    p = np.exp(scores - scores.max(axis=0))
    p /= p.sum(axis=0)
    truths = truth == np.arange(len(scores))[:, None]
    return np.rint((truths - p) * scale), np.rint(p * (1 - p) * scale)


def _widths(model: SymmetricModel) -> dict[int, int]:
    """Bins that matter of each feature: those it has and an empty one, the choice of no cut.

    Of the features without cuts only the first one can be chosen, where no cut gains anything.
    """
    kept = [f for f, cuts in enumerate(model.cuts) if cuts]
    kept += [f for f, cuts in enumerate(model.cuts) if not cuts][:1]
    return {f: min(max(2, model.settings.bins), len(model.cuts[f]) + 2) for f in sorted(kept)}


Sums = tuple[np.ndarray, np.ndarray, np.ndarray | None]


def _cells(at: np.ndarray, numbers: Iterable, leaves: int, width: int) -> np.ndarray:
    """Sums by cell of each column of whole numbers, or the count of rows for None; both exact."""
    sums = [np.bincount(at, x, leaves * width).reshape(leaves, width) for x in numbers]
    return np.stack(sums).astype(np.int64)


class _Gradients:
    """Gradients of one block for the trees at hand, which take ``depth`` passes."""

    def __init__(self, block: Block, model: SymmetricModel, scale: Mapping[int, float]) -> None:
        self.block, self.widths = block, _widths(model)
        self.slopes = [_slopes(target, block.truths[t], block.scores[t], scale[t]) for t, target in enumerate(model.targets)]

    def sums(self, grown: Sequence[Sequence[tuple[int, int]]], last: bool) -> Iterator[tuple[tuple[int, int], Sums]]:
        """(target, feature) with counts by (leaf, bin) and sums by (output, leaf, bin); curvatures if ``last``."""
        for t, (slopes, curves) in enumerate(self.slopes):
            leaf, leaves = _leaves(self.block.bins, grown[t]), 1 << len(grown[t])
            for f, width in self.widths.items():
                at = leaf * width + self.block.bins[f]
                yield (t, f), (_cells(at, [None], leaves, width)[0], _cells(at, slopes, leaves, width),
                               _cells(at, curves, leaves, width) if last and curves is not None else None)


def _both(a: Sums, b: Sums) -> Sums:
    return a[0] + b[0], a[1] + b[1], None if a[2] is None else a[2] + b[2]


@dataclass(frozen=True)
class Cut:
    """The best cut of one target and feature; leaf values by output at the last level."""

    target: int
    feature: int
    bin: int
    gain: float
    values: list[list[float]] | None


def _searched(settings: Symmetric, scale: Mapping[int, float], last: bool):
    """Best cut of one (target, feature) from its gradient sums: at most leaves x bins x outputs numbers."""
    l2 = settings.l2

    def search(found: tuple[tuple[int, int], Sums]) -> Cut:
        (target, feature), (n, g, h) = found
        left_n, left_g = n.cumsum(axis=1)[:, :-1], g.cumsum(axis=2)[:, :, :-1]
        right_n, right_g = n.sum(axis=1, keepdims=True) - left_n, g.sum(axis=2, keepdims=True) - left_g
        gain = (left_g.astype(float) ** 2 / (left_n + l2) + right_g.astype(float) ** 2 / (right_n + l2)).sum(axis=(0, 1))
        best = int(np.argmax(gain >= gain.max() * (1 - TIE)))
        values = None
        if last:
            if h is None:
                curves = np.concatenate([left_n[:, best], right_n[:, best]]) * scale[target]
            else:
                left = h[:, :, :best + 1].sum(axis=2)
                curves = np.concatenate([left, h.sum(axis=2) - left], axis=1)
            slopes = np.concatenate([left_g[:, :, best], right_g[:, :, best]], axis=1)
            values = (settings.learning_rate * slopes / (curves + l2 * scale[target])).tolist()
        return Cut(target, feature, best + 1, gain[best] / scale[target] ** 2, values)

    return search


Pass = Callable[[list[list[tuple[int, int]]], bool], Iterable[Cut]]


def _grown(model: SymmetricModel, best_cuts: Pass) -> list[Tree]:
    """One more tree for each target, level by level, from one pass over the rows for each level."""
    grown, chosen = [[] for _ in model.targets], []
    for depth in range(model.settings.depth):
        best: dict[int, list[Cut]] = {}
        for cut in best_cuts(grown, depth == model.settings.depth - 1):
            best.setdefault(cut.target, []).append(cut)
        chosen = []
        for t in range(len(model.targets)):
            most = max(c.gain for c in best[t])
            cut = min((c for c in best[t] if c.gain >= most * (1 - TIE)), key=lambda c: c.feature)
            grown[t].append((cut.feature, cut.bin))
            chosen.append(cut)
    # The last level is the highest bit: first the leaves on its left, then those on its right.
    return [Tree(tuple(levels), tuple(map(tuple, cut.values))) for levels, cut in zip(grown, chosen)]


def _packed(block: Block) -> dict:
    return {"n": block.bins.shape[1], "bins": block.bins.tobytes(), "truths": block.truths.tobytes(),
            "scores": np.concatenate(block.scores).tobytes()}


def _unpacked(row: Row, model: SymmetricModel) -> Block:
    bins = np.frombuffer(row["bins"], _bin_type(model.settings.bins)).reshape(-1, row["n"])
    truths, scores = (np.frombuffer(row[c], float).reshape(-1, row["n"]) for c in ("truths", "scores"))
    return Block(bins, truths, np.split(scores, np.cumsum([_outputs(t) for t in model.targets])[:-1]))


BLOCKS = "n long, bins binary, truths binary, scores binary"


def _rows_of_a_block(model: SymmetricModel) -> int:
    """Bins, truths, scores, gradients and curvatures of a row bound its block."""
    outputs = sum(map(_outputs, model.targets))
    return max(1, BLOCK_BYTES // (len(model.inputs) + 8 * len(model.targets) + 24 * outputs))


def _blocks(rows: DataFrame, model: SymmetricModel, most: int | None = None) -> DataFrame:
    """The rows as blocks of about the same size, one in a partition, with the scores of the model."""
    truths = []
    for t, target in enumerate(model.targets):
        truth = F.col(target.name)
        if target.classes is not None:
            labels = F.array(*[F.lit(c) for c in target.classes]) if target.classes else F.array(target.name)
            truth = F.array_position(labels, truth) - 1
        truths.append(truth.cast("double").alias(f"_y{t}"))
    numbers = [F.col(f"`{c}`").cast("double").alias(f"_x{i}") for i, c in enumerate(model.inputs)]
    given = rows.select(*numbers, *truths)
    features, targets = len(numbers), len(truths)

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [(_bins([f[f"_x{i}"].to_numpy() for i in range(features)], model),
                  np.stack([f[f"_y{t}"].to_numpy() for t in range(targets)])) for f in frames if len(f)]
        if parts:
            bins, truth = (np.concatenate(x, axis=1) for x in zip(*parts))
            bases = [np.repeat(np.array(t.base)[:, None], bins.shape[1], axis=1) for t in model.targets]
            yield pd.DataFrame([_packed(Block(bins, truth, bases).moved(model.trees))])

    count = max(1, math.ceil(rows.count() / (most or _rows_of_a_block(model))))
    return given.repartition(count).mapInPandas(pack, BLOCKS)


def _scale(rows: int, largest: float, bits: int = SUM_BITS) -> float:
    """Power of two that turns numbers up to ``largest`` into whole ones whose sum stays below 2^``bits``."""
    return 2.0 ** math.floor(bits - math.log2(rows) - math.log2(max(largest, 1.0 / rows)))


def _means(df: DataFrame, columns: Sequence[str]) -> list[float]:
    """Means from whole-number sums, the same to the last bit however the rows lie; 0 without rows."""
    numbers = [F.col(c).cast("double") for c in columns]
    rows, *largest = df.agg(F.count("*"), *[F.max(F.abs(c)) for c in numbers]).first()
    if not rows:
        return [0.0] * len(columns)
    scales = [_scale(rows, x) for x in largest]
    sums = df.agg(*[F.sum(F.round(c * F.lit(s)).cast("long")) for c, s in zip(numbers, scales)]).first()
    return [total / rows / s for total, s in zip(sums, scales)]


def _classes(df: DataFrame, target: str) -> tuple:
    """The values of a class target; each has its own column of leaf values in the model."""
    return tuple(sorted(r[0] for r in df.select(target).distinct().collect()))


def fit(
    train: DataFrame,
    features: Sequence[str],
    targets: Sequence[str],
    settings: Symmetric = Symmetric(),
    key: Sequence[str] = (),
    classify: bool | None = None,
) -> SymmetricModel:
    """Fit one sequence of symmetric trees for each target; all targets share every pass.

    Rows with a missing feature or target are left out; without rows the model predicts 0, or no
    class. Timestamps become their parts, text
    features the ordered statistics of each target in the hash order of ``key`` (all features without
    a key). Whole-number targets are classes unless ``classify`` says otherwise.
    """
    from bondscope.operators.models import problem_type  # models also offers this booster

    if classify is None:
        classify = problem_type(train, targets).endswith("classification")
    data = complete_rows(train.select(*dict.fromkeys([*key, *features, *targets])), [*features, *targets])
    texts, times = text_columns(data.select(*features)), time_columns(data.select(*features))
    known, path = handed_over(data, "boosting-rows")
    if classify:
        found = [_classes(known, name) for name in targets]
        chosen = [Target(name, classes, (0.0,) * max(1, len(classes))) for name, classes in zip(targets, found)]
    else:
        chosen = [Target(name, None, (mean,)) for name, mean in zip(targets, _means(known, targets))]
    marks = {name: column for target in chosen for name, column in _indicators(target).items()}
    rows, statistics, categories = _timed(known, times), {}, None
    if texts:
        marked = rows.withColumns({f"_m_{m}": c for m, c in marks.items()})
        means = [f"_m_{m}" for m in marks]
        statistics = priors(marked, means)
        categories, _ = handed_over(category_table(marked, texts, means), "boosting-categories")
        rows = ordered_statistics(marked, texts, means, hash_order(key or features), statistics).drop(*means)
    inputs = [f for f in features if f not in texts and f not in times]
    inputs += [f"{c}_{part}" for c in times for part in TIME_PARTS]
    inputs += [encoded_name(c, m) for c in texts for m in statistics]
    rows, shaped_path = handed_over(rows, "boosting-features")
    model = SymmetricModel(
        settings, tuple(features), tuple(texts), tuple(times), statistics, tuple(inputs),
        tuple(map(tuple, bin_cuts(rows, inputs, settings.bins))), tuple(chosen), tuple(() for _ in chosen), categories)
    model = _boosted(rows, model, settings.iterations)
    for stale in (path, shaped_path):
        removed(train.sparkSession, stale)
    return model


def extend(model: SymmetricModel, train: DataFrame, iterations: int, key: Sequence[str] = ()) -> SymmetricModel:
    """Go on from a stored model: more trees on the residuals that it leaves on ``train``.

    Cuts, categories, bases and classes are those of the model, so on the same rows n and m
    rounds equal n + m rounds, but for text features, which get the statistics of the model.
    """
    names = [t.name for t in model.targets]
    data = complete_rows(
        train.select(*dict.fromkeys([*key, *model.features, *names])), [*model.features, *names])
    rows = _timed(data, model.times)
    if model.texts:
        rows = with_statistics(rows, model.categories, model.texts, list(model.statistics), model.statistics)
    rows, path = handed_over(rows, "boosting-features")
    grown = _boosted(rows, model, iterations)
    removed(train.sparkSession, path)
    return grown


def _boosted(rows: DataFrame, model: SymmetricModel, iterations: int) -> SymmetricModel:
    """Add trees, in one task if there is one block. Else its scores are stored again after every few trees."""
    if not model.inputs or not any(model.cuts) or not iterations:
        return model
    spark, whole = rows.sparkSession, model
    model = replace(model, categories=None)  # a table, which no task can hold
    state, path = handed_over(_blocks(rows, model), "boosting-state")
    unpack = lambda row: _unpacked(row, model)
    scale = _scales(state.rdd.map(unpack), model)
    if not scale:
        trees = [[] for _ in model.targets]
    elif state.count() == 1:
        trees = state.rdd.map(lambda row: _grown_alone(unpack(row), model, scale, iterations)).first()
    else:
        trees, path = _grown_together(state, path, model, scale, iterations)
    removed(spark, path)
    return replace(whole, trees=tuple((*x, *more) for x, more in zip(model.trees, trees)))


def _grown_alone(block: Block, model: SymmetricModel, scale: dict[int, float], iterations: int) -> list[list[Tree]]:
    """All trees of a single block."""
    trees = [[] for _ in model.targets]
    for _ in range(iterations):
        gradients = _Gradients(block, model, scale)
        more = _grown(model, lambda grown, last: map(
            _searched(model.settings, scale, last), gradients.sums(grown, last)))
        block = block.moved([[tree] for tree in more])
        for t, tree in enumerate(more):
            trees[t].append(tree)
    return trees


def _grown_together(
    state: DataFrame, path: str, model: SymmetricModel, scale: dict[int, float], iterations: int,
) -> tuple[list[list[Tree]], str]:
    """The trees of several blocks, one job for each level, and the path of the last state."""
    spark, trees, since = state.sparkSession, [[] for _ in model.targets], [[] for _ in model.targets]
    keys = len(model.targets) * len(_widths(model))

    def kept(state: DataFrame):
        return state.rdd.map(lambda row: _unpacked(row, model)).persist(StorageLevel.MEMORY_AND_DISK)

    blocks = kept(state)
    tasks = min(keys, spark.sparkContext.defaultParallelism)
    for turn in range(iterations):
        moves = [tuple(x) for x in since]

        def best_cuts(grown: list[list[tuple[int, int]]], last: bool) -> list[Cut]:
            sums = blocks.flatMap(
                lambda block: _Gradients(block.moved(moves), model, scale).sums(grown, last))
            return sums.reduceByKey(_both, tasks).map(_searched(model.settings, scale, last)).collect()

        for t, tree in enumerate(_grown(model, best_cuts)):  # one cut for each target and feature
            trees[t].append(tree)
            since[t].append(tree)
        if len(since[0]) >= TREES_PER_STATE and turn + 1 < iterations:
            moves, stale, old = [tuple(x) for x in since], path, blocks
            moved = spark.createDataFrame(blocks.map(lambda block: Row(**_packed(block.moved(moves)))), BLOCKS)
            state, path = handed_over(moved, "boosting-state")
            blocks, since = kept(state), [[] for _ in model.targets]
            old.unpersist()
            removed(spark, stale)
    blocks.unpersist()
    return trees, path


def _scales(blocks, model: SymmetricModel) -> dict[int, float]:
    """Power of two for each target that turns gradients into whole numbers with safe sums; none without rows.

    Whole numbers add up to the same sum in any order, so a retry or another layout of the
    rows gives the same trees. Residuals of later rounds may be up to eight times the first.
    """
    def largest(block: Block) -> tuple[int, list[float]]:
        return block.bins.shape[1], [
            1.0 if target.classes is not None else float(np.abs(block.truths[t] - block.scores[t]).max())
            for t, target in enumerate(model.targets)]

    found = blocks.map(largest).collect()  # one row for each block
    rows = sum(n for n, _ in found)
    if not rows:
        return {}
    most = [8 * max(x[t] for _, x in found) for t in range(len(model.targets))]
    in_block = min(rows, _rows_of_a_block(model)) * 2  # blocks are about equal
    return {t: min(_scale(rows, x), _scale(in_block, x, BLOCK_SUM_BITS)) for t, x in enumerate(most)}


def _firsts(model: SymmetricModel) -> list[int]:
    """Place of the first output of each target."""
    return np.cumsum([0, *map(_outputs, model.targets)])[:-1].tolist()


def _summed(model: SymmetricModel) -> Column:
    """Array of the scores of a row, all outputs of all targets."""
    if not any(model.trees):
        return F.array(*[F.lit(b) for target in model.targets for b in target.base])
    model = replace(model, categories=None)  # a table, which no task can hold

    @F.pandas_udf("array<double>")
    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for frame in frames:
            bins = _bins([frame[c].to_numpy() for c in frame], model)
            bases = [np.repeat(np.array(t.base)[:, None], bins.shape[1], axis=1) for t in model.targets]
            found = [_added(base, bins, trees) for base, trees in zip(bases, model.trees)]
            yield pd.Series(list(np.concatenate(found).T))

    return scored(F.struct(*[F.col(f"`{c}`").cast("double").alias(f"_x{i}") for i, c in enumerate(model.inputs)]))


def score(
    model: SymmetricModel,
    df: DataFrame,
    key: Sequence[str],
    chances: bool = False,
) -> DataFrame:
    """Key and one prediction for each target, for every row with complete features.

    A class target gives its likeliest class (the first of equal ones); with ``chances`` also
    ``<target>_chances``, in the order of the classes.
    """
    rows = complete_rows(df.select(*dict.fromkeys([*key, *model.features])), model.features)
    rows = _timed(rows, model.times)
    if model.texts:
        rows = with_statistics(rows, model.categories, model.texts, list(model.statistics), model.statistics)
    summed = _summed(model)
    scores = rows.select(*key, *[F.slice(summed, first + 1, _outputs(target)).alias(f"_s{t}")
                                 for t, (target, first) in enumerate(zip(model.targets, _firsts(model)))])
    found = []
    for t, target in enumerate(model.targets):
        if target.classes is None:
            found.append(F.get(f"_s{t}", F.lit(0)).alias(target.name))
            continue
        place = F.array_position(f"_s{t}", F.array_max(f"_s{t}"))
        named = F.get(F.array(*[F.lit(c) for c in target.classes]), (place - 1).cast("int"))
        found.append((named if target.classes else F.lit(None)).alias(target.name))
        if chances:
            found.append(_softmax(f"_s{t}").alias(f"{target.name}_chances"))
    return scores.select(*key, *found)


def _softmax(scores: str) -> Column:
    raised = F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))
    whole = F.aggregate(raised, F.lit(0.0), lambda a, b: a + b)
    return F.transform(raised, lambda e: e / whole)


def tree_table(model: SymmetricModel, spark: SparkSession) -> DataFrame:
    """The trees as rows: target, tree, level, feature, cut (rows from it up go right)."""
    rows = [
        (target.name, i, level, model.inputs[f], float(model.cuts[f][b - 1]) if b <= len(model.cuts[f]) else None)
        for target, trees in zip(model.targets, model.trees) for i, tree in enumerate(trees)
        for level, (f, b) in enumerate(tree.levels)]
    return spark.createDataFrame(rows, "target string, tree int, level int, feature string, cut double")


def save(model: SymmetricModel, spark: SparkSession, path: str) -> None:
    """Write the model below ``path``: one row of JSON, the trees, and the categories."""
    head = {
        "settings": asdict(model.settings), "features": model.features, "texts": model.texts, "times": model.times,
        "statistics": model.statistics, "inputs": model.inputs, "cuts": model.cuts,
        "targets": [asdict(t) for t in model.targets]}
    spark.createDataFrame([(json.dumps(head),)], "model string").coalesce(1).write.parquet(f"{path}/model")
    rows = [(t, i, [list(x) for x in tree.levels], [list(v) for v in tree.values])
            for t, trees in enumerate(model.trees) for i, tree in enumerate(trees)]
    spark.createDataFrame(
        rows, "target int, tree int, levels array<array<int>>, values array<array<double>>"
    ).coalesce(1).write.parquet(f"{path}/trees")
    if model.categories is not None:
        model.categories.write.parquet(f"{path}/categories")


def load(spark: SparkSession, path: str) -> SymmetricModel:
    """Read a model that ``save`` wrote."""
    head = json.loads(spark.read.parquet(f"{path}/model").first()[0])
    targets = tuple(Target(t["name"], None if t["classes"] is None else tuple(t["classes"]), tuple(t["base"]))
                    for t in head["targets"])
    found = [{} for _ in targets]
    for r in spark.read.parquet(f"{path}/trees").collect():  # rounds x targets rows
        found[r.target][r.tree] = Tree(tuple(map(tuple, r.levels)), tuple(map(tuple, r["values"])))
    return SymmetricModel(
        Symmetric(**head["settings"]), tuple(head["features"]), tuple(head["texts"]), tuple(head["times"]),
        head["statistics"], tuple(head["inputs"]), tuple(map(tuple, head["cuts"])), targets,
        tuple(tuple(x[i] for i in sorted(x)) for x in found),
        spark.read.parquet(f"{path}/categories") if head["texts"] else None)
