"""Benchmark decontamination: a prefix-filtered containment join of item windows and documents."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondscope.llm.common import hot_keys, spread_join, stored
from bondscope.storage import fresh_path

WINDOW = 10
SHINGLE = 5
FILTER_BITS = 1 << 26
PLACE = np.random.default_rng(8).integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)
BLANK = bytes(c if c >= 128 or chr(c).isdigit() or "a" <= chr(c) <= "z" else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Runs of digits, letters and characters beyond ASCII, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(BLANK).split()


def word_hashes(tokens: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    if len(known) > 200_000:
        known.clear()
    for token in set(tokens).difference(known):
        known[token] = xxhash.xxh3_64_intdigest(token)
    return np.fromiter(map(known.__getitem__, tokens), dtype=np.uint64, count=len(tokens))


def grams(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each position."""
    if len(hashes) < width:
        return np.empty(0, dtype=np.int64)
    out = np.full(len(hashes) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        part = hashes[i:len(hashes) - width + 1 + i] * PLACE[i]
        out = (out ^ (part ^ (part >> np.uint64(32)))) * MIX
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def _windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for item, text in zip(frame.item_id, frame.text):
            tokens = words(text)
            length = min(WINDOW, len(tokens))
            width = min(SHINGLE, length)
            tokens_hash = grams(word_hashes(tokens, {}), width) if length else []
            for at in range(len(tokens) - length + 1 if length else 0):
                inside = tokens_hash[at:at + length - width + 1].tolist()
                out.append((item, b" ".join(tokens[at:at + length]).decode(errors="surrogatepass"), length, width, inside))
        yield pd.DataFrame(out, columns=["item_id", "window", "length", "width", "tokens"])


def _bits(tokens: DataFrame) -> np.ndarray:
    """Bloom filter of the tokens; its size is fixed whatever the benchmark holds."""
    places = tokens.select(F.pmod("token", F.lit(FILTER_BITS)).alias("place")).distinct()

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            byte = frame.place.to_numpy() >> 3
            out = pd.DataFrame({"byte": byte, "bit": np.left_shift(1, frame.place.to_numpy() & 7)})
            yield out.groupby("byte", as_index=False).bit.sum()

    packed = places.mapInPandas(pack, "byte long, bit long").groupBy("byte").agg(F.sum("bit").alias("bit"))
    field = np.zeros(FILTER_BITS >> 3, dtype=np.uint8)
    for row in packed.toLocalIterator():  # at most FILTER_BITS / 8 rows
        field[row.byte] = row.bit
    return field


def _held(field: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Whether the Bloom filter may hold each token."""
    place = tokens % FILTER_BITS
    return ((field[place >> 3] >> (place & 7)) & 1).astype(bool)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Words of ``docs`` (doc_id, text) inside windows of ``benchmark`` (item_id, text).

    A window is WINDOW consecutive words of an item, or the whole of a shorter one. Its
    shingles are ordered by their frequency in all documents; as containment is exact, the
    prefix is the rarest one. Documents meet windows on that token, at the position it has
    in the window and with enough words around it, and the words are then compared. Returns
    doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for every row; rows that
    repeat a doc_id are separate. Null and empty texts have no words and no hits, null or
    empty items no windows; items with a null id count as windows without an item. Further
    columns are ignored. Without documents there are no rows.
    """
    spark = docs.sparkSession
    windows = stored(benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInPandas(
        _windows, "item_id string, window string, length int, width int, tokens array<long>"), "windows")
    plain = windows.dropDuplicates(["window"]).drop("item_id")
    tokens = plain.select("width", F.explode("tokens").alias("token")).distinct()
    widths = sorted(r.width for r in plain.select("width").distinct().collect())  # at most SHINGLE rows
    all_tokens = spark.sparkContext.broadcast(_bits(tokens))
    # Ids may repeat: rows are told apart by a hash of id and text with its copies kept together.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, int] = {}
        for frame in frames:
            found = []
            for text in frame.text:
                hashes = word_hashes(words(text), known)
                for width in widths:
                    made = grams(hashes, width)
                    found.append(made[_held(all_tokens.value, made)])
            token, n = np.unique(np.concatenate(found), return_counts=True) if found else ([], [])
            yield pd.DataFrame({"token": token, "n": n})

    frequency = stored(rows.select("text").mapInPandas(count, "token long, n long").groupBy("token").agg(
        F.sum("n").alias("n")), "frequency")
    placed = plain.select("window", "length", "width", F.posexplode("tokens").alias("offset", "token"))
    ranked = placed.join(frequency, "token").groupBy("window", "length", "width").agg(
        F.min(F.struct("n", "token", "offset")).alias("rarest"), F.count("*").alias("seen"))
    # A window with a shingle that no document has occurs nowhere.
    prefix = stored(ranked.where(F.col("seen") == F.col("length") - F.col("width") + 1).select(
        "window", "length", "width", "rarest.token", "rarest.offset", "rarest.n"), "prefix")
    rare = spark.sparkContext.broadcast(_bits(prefix.select("token")))

    def meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, int] = {}
        for frame in frames:
            out = []
            for doc_id, key, text in zip(frame.doc_id, frame.key, frame.text):
                tokens = words(text)
                hashes = word_hashes(tokens, known)
                out.append((doc_id, key, len(tokens), None, None, None, None))
                for width in widths:
                    made = grams(hashes, width)
                    for at in np.flatnonzero(_held(rare.value, made)).tolist():
                        low = max(0, at - WINDOW + width)
                        near = b" ".join(tokens[low:at + WINDOW]).decode(errors="surrogatepass")
                        out.append((doc_id, key, len(tokens), int(made[at]), at, low, near))
            if not out:
                continue
            columns = zip(("doc_id", "key", "n_words", "token", "at", "low", "near"), zip(*out))
            # Whole numbers beside nulls would pass through doubles without a type of their own.
            yield pd.DataFrame({name: pd.array(found, dtype="object" if name in ("doc_id", "near") else "Int64") for name, found in columns})

    # Ids travel as text: numbers beside nulls would pass through doubles.
    keyed = rows.select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("doc_id", "text").alias("key"), "text")
    path = fresh_path(spark, "met")
    found = keyed.mapInPandas(
        meet, "doc_id string, key long, n_words long, token long, at long, low long, near string")
    found.withColumn("doc_id", F.col("doc_id").cast("long")).write.parquet(path)
    met = spark.read.parquet(path)
    found = met.where("token IS NOT NULL").select("key", "token", "at", "low", "near")
    hot = hot_keys(found.groupBy("token").agg(F.count("*").alias("n")), "token", "n")
    joined = spread_join(found, prefix.drop("n", "width"), "token", hot, F.xxhash64("key", "at"))
    start = F.col("at") - F.col("offset")
    around = F.split("near", " ")
    first = (start - F.col("low")).cast("int")
    exact = joined.where(start >= F.col("low")).where(F.size(around) >= first + F.col("length")).where(
        F.concat_ws(" ", F.slice(around, first + 1, F.col("length"))) == F.col("window"))
    hits = stored(exact.select("key", start.alias("start"), "length", "window").distinct(), "hits")
    covered = hits.groupBy("key").agg(F.size(F.array_distinct(F.flatten(F.collect_set(
        F.sequence(F.col("start"), F.col("start") + F.col("length") - 1))))).cast("long").alias("n_hit"))
    seen = hits.groupBy("window").agg(F.count("*").alias("n"))
    hot = hot_keys(seen, "window", "n")
    owners = windows.select("window", "item_id").distinct()
    items = spread_join(hits.select("key", "window").distinct(), owners, "window", hot, F.col("key")).groupBy("key").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"))
    counts = covered.join(items, "key")
    base = met.where("token IS NULL").select("doc_id", "key", "n_words")
    none = F.array().cast("array<string>")
    return base.join(counts, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))
