"""Toxicity grades by cumulative-link ordinal regression on sparse text features."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bondscope.llm.decontamination import words

FEATURES = 1 << 20
TRAIN_ROWS = 20_000
LEAST_ROWS = 4
ROUNDS = 300
PENALTY = 1.0
REJECT = 0.5
#: Features that a step of the fit takes at a time: its memory does not grow with the rows beside them.
BLOCK = 1 << 17


def features(text: str | None) -> np.ndarray:
    """Sorted distinct hashed words."""
    return np.unique(np.array([xxhash.xxh3_64_intdigest(w) % FEATURES for w in set(words(text))], dtype=np.int64))


def _features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for at in range(0, len(frame), 500):
            part = frame.iloc[at:at + 500]
            yield pd.DataFrame({"grade": part.grade, "found": [features(t).astype(np.int32) for t in part.text]})


def fit(rows: list[np.ndarray], grades: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, their weights and the ordered thresholds of P(grade <= k) = s(threshold_k - score).

    All thresholds share the weights. Full-batch gradient steps scaled for each feature, with an
    absolute penalty that leaves rare words without weight.
    """
    levels = int(grades.max()) if len(grades) else 0
    n = np.zeros(FEATURES, dtype=np.int64)
    for found in rows:
        n[found] += 1
    often = n >= LEAST_ROWS
    names = np.flatnonzero(often)
    place = np.cumsum(often, dtype=np.int32) - np.int32(1)
    size = np.array([np.count_nonzero(often[found]) for found in rows], dtype=np.int64)
    end = np.concatenate([[0], np.cumsum(size)])
    column = np.empty(end[-1], dtype=np.int32)
    for found, at, to in zip(rows, end, end[1:]):
        column[at:to] = place[found[often[found]]]
    # Whole rows, about BLOCK features in each block.
    cut = np.unique(np.concatenate([np.searchsorted(end, np.arange(0, end[-1], BLOCK)), [len(rows)]]))
    weight, scale = np.zeros(len(names)), np.full(len(names), 1e-2)
    share = np.clip([(grades <= k).mean() for k in range(levels)], 1e-3, 1 - 1e-3)
    cuts = np.log(share / (1 - share))
    cut_scale = np.full(levels, 1e-2)
    for _ in range(ROUNDS if levels else 0):
        score = np.zeros(len(rows))
        for a, b in zip(cut, cut[1:]):
            row = np.repeat(np.arange(b - a), size[a:b])
            score[a:b] = np.bincount(row, weight[column[end[a]:end[b]]], b - a)
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        with np.errstate(over="ignore"):
            above = 1 / (1 + np.exp(-(edges[grades + 1] - score)))
            below = 1 / (1 + np.exp(-(edges[grades] - score)))
        chance = np.maximum(above - below, 1e-9)
        push, slope = 1 - above - below, np.zeros(len(names))
        for a, b in zip(cut, cut[1:]):
            np.add.at(slope, column[end[a]:end[b]], np.repeat(push[a:b], size[a:b]))
        scale += slope**2
        step = 0.5 / np.sqrt(scale)
        weight -= step * slope
        weight = np.sign(weight) * np.maximum(np.abs(weight) - step * PENALTY, 0)
        cut_slope = np.array([
            (below * (1 - below) / chance)[grades == k + 1].sum() - (above * (1 - above) / chance)[grades == k].sum()
            for k in range(levels)])
        cut_scale += cut_slope**2
        cuts = np.sort(cuts - 0.5 / np.sqrt(cut_scale) * cut_slope)
    used = weight != 0
    return names[used], weight[used], cuts


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Model of TRAIN_ROWS labelled documents at most, the smallest by hash of doc_id.

    Grades: 0 without toxic label, 1 toxic, 2 toxic and of low quality. A doc_id with several
    labels takes the highest; null labels are left out. Without labels the model is empty.
    """
    grade = F.when(F.col("toxic") == 0, 0).when(F.coalesce("quality", F.lit(1)) == 0, 2).otherwise(1)
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(grade).alias("grade"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = texts.join(known, "doc_id").select("grade", "text").mapInPandas(_features, "grade int, found array<int>")

    def fit_all(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("grade", kind="stable")
        names, weight, cuts = fit(list(frame.found), frame.grade.to_numpy(np.int64))
        return pd.DataFrame({
            "name": np.concatenate([names, -1 - np.arange(len(cuts))]), "value": np.concatenate([weight, cuts])})

    # One task over the bounded sample; at most FEATURES values come back.
    model = rows.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fit_all, "name long, value double").toPandas().sort_values("name")
    words_ = model[model.name >= 0]
    cuts = model[model.name < 0].value.to_numpy()[::-1]
    return words_.name.to_numpy(), words_.value.to_numpy(), cuts


def chances(text: Column, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Column:
    """Array of P(grade > k) for each threshold k of the model; empty for an empty model."""
    names, weight, cuts = model
    table = dict(zip(names.tolist(), weight.tolist()))

    @F.pandas_udf("array<double>")
    def scored(texts: pd.Series) -> pd.Series:
        score = np.array([sum(table.get(f, 0.0) for f in features(t).tolist()) for t in texts])
        if not len(cuts):
            return pd.Series([[] for _ in texts])
        return pd.Series(list(1 / (1 + np.exp(np.clip(cuts[None, :] - score[:, None], -700, 700)))))

    return scored(text)


def graded(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) with severity, toxic and kept.

    Severity is the expected grade; a row is toxic from P(grade > 0) >= REJECT. Null and
    empty texts score as texts without words. Repeated rows score alike; no rows give none.
    """
    found = docs.select("doc_id", chances(F.col("text"), train(docs, labels)).alias("p"))
    toxic = F.coalesce(F.try_element_at("p", F.lit(1)) >= REJECT, F.lit(False))
    return found.select(
        "doc_id", F.aggregate("p", F.lit(0.0), lambda a, b: a + b).alias("severity"),
        toxic.alias("toxic"), (~toxic).alias("kept"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All columns of the rows that are not toxic, see ``graded``."""
    first = F.try_element_at(chances(F.col("text"), train(docs, labels)), F.lit(1))
    return docs.where(~F.coalesce(first >= REJECT, F.lit(False)))
