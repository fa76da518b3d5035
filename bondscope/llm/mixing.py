"""Mixing of sources to target weights by blocks that are drawn per output shard."""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondscope.llm.common import stored, word_count

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 32
SHARD_SLOTS = 8_192
MAX_SOURCES = 100_000


def targets(sizes: list[int], weights: list[float], total: float, repeats: float = MAX_REPEATS) -> list[float]:
    """Share ``total`` by weight; a source stops at ``repeats`` times its size, the rest is reshared."""
    found, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = total
    while open_:
        weight = sum(weights[i] for i in sorted(open_))
        over = {i for i in open_ if left * weights[i] / weight > repeats * sizes[i]}
        for i in sorted(over or open_):
            found[i] = float(repeats * sizes[i]) if over else left * weights[i] / weight
        if not over:
            break
        left -= sum(repeats * sizes[i] for i in sorted(over))
        open_ -= over
    return found


def _split(quota: np.ndarray, left: int, seed: tuple[int, ...]) -> np.ndarray:
    """Multinomial counts of the first ``left`` slots, held within the quotas."""
    total = int(quota.sum())
    if left <= 0 or total == 0:
        return np.zeros_like(quota)
    drawn = np.random.default_rng(seed).multinomial(left, quota / total)
    drawn = np.minimum(drawn, quota)
    short = left - int(drawn.sum())
    room = quota - drawn
    before = np.concatenate([[0], np.cumsum(room)[:-1]])
    return drawn + np.clip(short - before, 0, room)


def shard_counts(quota: np.ndarray, shards: int, slots: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """First slot and count of every source in one shard, by binary splitting of all shards.

    Every shard finds its own counts from the quotas alone; their sum is the quota exactly.
    """
    low, high, first, quota = 0, shards, np.zeros_like(quota), quota.copy()
    while high - low > 1:
        middle = (low + high) // 2
        head = _split(quota, min((middle - low) * slots, int(quota.sum())), (seed, low, high))
        if shard < middle:
            high, quota = middle, head
        else:
            low, first, quota = middle, first + head, quota - head
    return first, quota


def permuted(index: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Pseudorandom permutation of range(size): a Feistel network with cycle walking."""
    half = max(1, (max(2, size) - 1).bit_length() + 1 >> 1)
    mask = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    todo = np.ones(len(out), dtype=bool)
    keys = np.random.default_rng(seed).integers(1, 2**63, 4, dtype=np.uint64) | np.uint64(1)
    while todo.any():
        value = out[todo]
        high, low = value >> np.uint64(half), value & mask
        for key in keys:
            mixed = (low + key) * np.uint64(0x9E3779B97F4A7C15)
            high, low = low, high ^ ((mixed ^ (mixed >> np.uint64(29))) * key >> np.uint64(31) & mask)
        out[todo] = high << np.uint64(half) | low
        todo = out >= size
    return out.astype(np.int64)


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """Pieces of the mix, and the documents with their offsets.

    ``docs`` has doc_id, source and text. The words of a source, its documents in a fixed
    order, are packed into blocks of BLOCK_WORDS words. A source takes its target in whole
    blocks, over the shards by multinomial draws; the slots of a source pass through one
    permutation of its blocks for each repeat, so that no block is used more than
    MAX_REPEATS times. The first result has one row for a document in a drawn block: doc_id,
    source_no, start, block, from_word, to_word (within the document) and ``times``. The
    second has doc_id, source, size, source_size, target, source_no and start.

    Null texts have no words; null is a source of its own, the last. Repeated rows are
    documents of their own. An empty table gives empty results.
    """
    spark = docs.sparkSession
    sized = stored(_sized(docs), "sized")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    found = per_source.limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = [r["size"] for r in found]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], sum(sizes))
    blocks = np.array([-(-s // BLOCK_WORDS) for s in sizes], dtype=np.int64)
    quota = np.array([
        min(MAX_REPEATS * int(b), max(round(g * b / s), 1 if g > 0 else 0)) if s else 0
        for g, b, s in zip(goal, blocks, sizes)], dtype=np.int64)
    sources = spark.createDataFrame(
        [(i, r.source, s, float(g)) for i, (r, s, g) in enumerate(zip(found, sizes, goal))],
        "source_no int, source string, source_size long, target double")
    chunks = 1 + math.isqrt(sum(r.rows for r in found))  # neither level of the running sum holds more than the root
    # At most MAX_SOURCES short rows.
    keyed = sized.join(F.broadcast(sources), sized.source.eqNullSafe(sources.source)).drop(sources.source)
    keyed = keyed.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)))
    totals = keyed.groupBy("source_no", "chunk").agg(F.sum("size").alias("chunk_size"))
    before = totals.select("source_no", "chunk", F.expr(
        "coalesce(sum(chunk_size) OVER (PARTITION BY source_no ORDER BY chunk "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("chunk_start"))
    placed = keyed.withColumn("start", F.expr(
        "coalesce(sum(size) OVER (PARTITION BY source_no, chunk ORDER BY doc_id, size "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"))
    placed = stored(placed.join(before, ["source_no", "chunk"]).withColumn(
        "start", F.col("start") + F.col("chunk_start")).drop("chunk", "chunk_start"), "placed")

    shards = max(1, math.ceil(int(quota.sum()) / SHARD_SLOTS))

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard in frame["id"]:
                first, count = shard_counts(quota, shards, SHARD_SLOTS, int(shard), seed)
                for no in np.flatnonzero(count):
                    slots = np.arange(first[no], first[no] + count[no])
                    for turn in np.unique(slots // blocks[no]):
                        index = slots[slots // blocks[no] == turn] % blocks[no]
                        yield pd.DataFrame({
                            "shard": np.int64(shard), "source_no": np.int32(no),
                            "block": permuted(index, int(blocks[no]), seed + 1_000_003 * int(turn) + int(no))})

    slots = spark.range(0, shards, 1, min(shards, 10_000)).mapInPandas(draw, "shard long, source_no int, block long")
    times = slots.groupBy("source_no", "block").agg(F.count("*").alias("times"))
    end = F.col("start") + F.col("size")
    pieces = placed.where("size > 0").select(
        "doc_id", "source_no", "start", "size",
        F.explode(F.sequence(F.floor(F.col("start") / BLOCK_WORDS), F.floor((end - 1) / BLOCK_WORDS))).alias("block"))
    # Spark takes the drawn blocks to be as few as the shards and would broadcast them; they grow with the words.
    pieces = pieces.join(times.hint("merge"), ["source_no", "block"]).select(
        "doc_id", "source_no", "start", "block", "times",
        (F.greatest(F.col("block") * BLOCK_WORDS, "start") - F.col("start")).alias("from_word"),
        (F.least((F.col("block") + 1) * BLOCK_WORDS, end) - F.col("start")).alias("to_word"))
    return pieces, placed


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = 17) -> DataFrame:
    """doc_id, size, source_size, target and ``taken`` words of every document, see ``mix``."""
    pieces, placed = mix(docs, weights, seed)
    key = ["doc_id", "source_no", "start"]
    taken = pieces.groupBy(*key).agg(F.sum(F.col("times") * (F.col("to_word") - F.col("from_word"))).alias("taken"))
    full, some = placed.alias("p"), taken.alias("t")
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"t.{k}")) for k in key] + [F.col("p.size") > 0]
    return full.join(some, same, "left").select(
        "p.doc_id", "p.size", "p.source_size", "p.target",
        F.coalesce("t.taken", F.lit(0)).cast("long").alias("taken"))
