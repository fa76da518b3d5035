"""Quality selection by importance resampling of hashed n-grams."""

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondscope.llm.decontamination import words
from bondscope.llm.common import rows_of, stored
from bondscope.operators.ranks import exact_quantile

BUCKETS = 10_000
SHARE = 0.5
#: Grams that a text's weight stands for at most.
PIECE = 32


def bag(text: str | None) -> np.ndarray:
    """Counts of hashed words and word pairs."""
    tokens = words(text)
    grams = tokens + [a + b" " + b for a, b in zip(tokens, tokens[1:])]
    return np.bincount([xxhash.xxh3_64_intdigest(g) % BUCKETS for g in grams] if grams else [0] * 0, minlength=BUCKETS)


def weights(texts: Iterable[str | None], ratio: np.ndarray) -> pd.DataFrame:
    """log_ratio and grams of each text, one bag at a time: those of a batch take BUCKETS longs a text."""
    found = [(float(b @ ratio), int(b.sum())) for b in map(bag, texts)]
    return pd.DataFrame(found, columns=["log_ratio", "grams"])


def _counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    found = np.zeros(BUCKETS, dtype=np.int64)
    for frame in frames:
        for text in frame.text:
            found += bag(text)
    yield pd.DataFrame({"bucket": np.arange(BUCKETS), "n": found})


def counted(texts: DataFrame, name: str) -> DataFrame:
    """Counts of the hashed grams of all texts: (bucket, name)."""
    parts = texts.select("text").mapInPandas(_counts, "bucket int, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias(name))


def resampled(docs: DataFrame, labels: DataFrame, share: float = SHARE, seed: int = 23) -> DataFrame:
    """doc_id, log_ratio, key and kept of every row of ``docs`` (doc_id, text).

    Two generative models count hashed words and word pairs of all documents, and of those
    labelled with quality 1. ``log_ratio`` is that of the whole text. A text weighs as much
    as PIECE of its grams on average, so that long texts are not beyond all noise; this
    weight plus Gumbel noise from a hash of its id is its key. The ``share`` of rows with the
    largest keys is kept, which is a sample without replacement by importance. Null and
    empty texts have ratio 0; a null id has noise of its own. Without labels of quality 1 the
    target model is uniform. Rows that repeat tie and are kept or left together. An empty
    table gives no rows; further columns are ignored; texts are read whole.
    """
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = counted(rows, "raw").join(counted(rows_of(rows, good), "target"), "bucket", "left").na.fill(0)
    table = counts.toPandas().sort_values("bucket")  # BUCKETS rows
    raw = table.raw.to_numpy(float) if len(table) else np.zeros(BUCKETS)
    target = table.target.to_numpy(float) if len(table) else np.zeros(BUCKETS)
    ratio = np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))

    @F.pandas_udf("log_ratio double, grams long")
    def weighed(texts: pd.Series) -> pd.DataFrame:
        return weights(texts, ratio)

    uniform = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    weight = F.col("w.log_ratio") * F.least(F.lit(1.0), PIECE / F.greatest(F.col("w.grams"), F.lit(1)))
    keyed = stored(rows.select("doc_id", weighed("text").alias("w")).select(
        "doc_id", "w.log_ratio", (weight - F.log(-F.log(uniform))).alias("key")), "keys")
    cut = exact_quantile(keyed, "key", 1 - share).first()
    least = cut[0] if cut and cut[0] is not None else 0.0
    return keyed.withColumn("kept", F.col("key") >= least)
