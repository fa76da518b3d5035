"""Language identification by rank-order n-gram profiles."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

TOP = 300
MAX_LANGUAGES = 1_000
PIECE = 1 << 20


def n_grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of the n-grams of one to three letters, words padded by one blank."""
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    text = (text or "").lower()
    for at in range(0, len(text), PIECE):
        # Two characters of context keep the n-grams across pieces.
        code = np.frombuffer(text[max(0, at - 2):at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        distinct, place = np.unique(code, return_inverse=True)
        letter = np.array([chr(c).isalpha() for c in distinct])
        code = np.where(letter[place], code, 32)
        skip = min(2, at)
        if not at:
            code = np.concatenate([[32, 32], code])
            skip = 2
        if at + PIECE >= len(text):
            code = np.concatenate([code, [32]])
        one, two, three = code[skip:], code[skip - 1:-1], code[skip - 2:-2]
        for key, kept in (
            (one, one != 32), (two << 21 | one, (one != 32) | (two != 32)),
            (three << 42 | two << 21 | one, (two != 32) & ((one != 32) | (three != 32))),
        ):
            found, n = np.unique(key[kept], return_counts=True)
            keys, counts = np.concatenate([keys, found]), np.concatenate([counts, n])
    if len(text) > PIECE:
        keys, place = np.unique(keys, return_inverse=True)
        counts = np.bincount(place, counts, len(keys)).astype(np.int64)
    return keys, counts


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for lang, texts in frame.groupby("lang").text:
            found = [n_grams(t) for t in texts]
            keys, place = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            n = np.bincount(place, np.concatenate([c for _, c in found]), len(keys)).astype(np.int64)
            yield pd.DataFrame({"lang": lang, "gram": keys, "n": n})


def profiles(train: DataFrame) -> dict[str, np.ndarray]:
    """The TOP n-grams of each language, most frequent first, over all rows (lang, text)."""
    known = train.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), "text")
    counts = known.mapInPandas(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # Only the first TOP of a language leave each task before the shuffle.
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    found = top.select("lang", "gram", "rank").limit(TOP * MAX_LANGUAGES + 1).toPandas()
    if len(found) > TOP * MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    found = found.sort_values(["lang", "rank"])
    return {lang: part.gram.to_numpy() for lang, part in found.groupby("lang")}


def distance(document: np.ndarray, profile: np.ndarray) -> int:
    """Sum of the out-of-place distances of a document's ranks; TOP for an n-gram that is missing."""
    order = np.argsort(profile)
    at = np.minimum(np.searchsorted(profile, document, sorter=order), len(profile) - 1)
    rank = order[at]
    return int(np.where(profile[rank] == document, np.abs(rank - np.arange(len(document))), TOP).sum())


def identified(text: Column, known: dict[str, np.ndarray]) -> Column:
    """Struct of lang_pred and score, see ``languages``."""

    @F.pandas_udf("lang_pred string, score double")
    def scored(texts: pd.Series) -> pd.DataFrame:
        out = []
        for one in texts:
            keys, counts = n_grams(one)
            if not len(keys) or not known:
                out.append(("und", 0.0))
                continue
            document = keys[np.lexsort((keys, -counts))[:TOP]]
            far = sorted((distance(document, profile), lang) for lang, profile in known.items())
            out.append((far[0][1], 1 - far[0][0] / (TOP * len(document))))
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    return scored(text)


def languages(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs`` (doc_id, text, lang).

    Profiles come from rows with a language that are not held out; a null ``held_out`` counts
    as not held out. The nearest profile wins, ties by name. The score is one less the share
    of the greatest possible distance. Texts that are null or without letters, and all texts
    where no language is known, are ``und`` with score 0. Rows that repeat give equal rows.
    """
    flagged = docs.select("doc_id", "text", "lang", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    known = profiles(flagged.where("NOT held_out"))
    return flagged.select("doc_id", "held_out", identified(F.col("text"), known).alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score")
