"""Exact deduplication through a cuckoo-filter index of live digests."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bondscope.llm.common import hot_keys, spread_join, stored

SLOTS = 4
MAX_KICKS = 200
BUCKET_DIGESTS = 500
PARTS = 16


class CuckooFilter:
    """16-bit fingerprints in buckets of four, two candidate buckets for each key.

    Keys are digests (bytes). The filter supports insertion and deletion; a full filter is
    built again with twice the buckets from the stored keys of its owner.
    """

    def __init__(self, capacity: int):
        self.buckets = 1 << max(4, int(np.ceil(np.log2(max(1, capacity) / (0.9 * SLOTS)))))
        self.table: list[list[int]] = [[] for _ in range(self.buckets)]

    def _places(self, key: bytes) -> tuple[int, int, int]:
        print_ = int.from_bytes(key[:2], "little") or 1
        first = int.from_bytes(key[2:10], "little") % self.buckets
        return print_, first, self._other(first, print_)

    def _other(self, bucket: int, print_: int) -> int:
        return bucket ^ ((print_ * 0x5BD1E995) % self.buckets)

    def __contains__(self, key: bytes) -> bool:
        print_, first, second = self._places(key)
        return print_ in self.table[first] or print_ in self.table[second]

    def insert(self, key: bytes) -> bool:
        """False when the key finds no place; the filter is then due for a rebuild."""
        print_, bucket, second = self._places(key)
        for place in (bucket, second):
            if len(self.table[place]) < SLOTS:
                self.table[place].append(print_)
                return True
        for kick in range(MAX_KICKS):
            row = self.table[bucket]
            row[kick % SLOTS], print_ = print_, row[kick % SLOTS]
            bucket = self._other(bucket, print_)
            if len(self.table[bucket]) < SLOTS:
                self.table[bucket].append(print_)
                return True
        return False

    def delete(self, key: bytes) -> bool:
        print_, first, second = self._places(key)
        for place in (first, second):
            if print_ in self.table[place]:
                self.table[place].remove(print_)
                return True
        return False


class LiveIndex:
    """Live digests with their best row: the filter answers first, the stored keys verify."""

    def __init__(self, capacity: int = 64):
        self.filter = CuckooFilter(capacity)
        self.rows: dict[bytes, list] = {}

    def _insert(self, digest: bytes) -> None:
        if not self.filter.insert(digest):
            self._resize()

    def _resize(self) -> None:
        size = 2 * self.filter.buckets * SLOTS
        while True:
            self.filter = CuckooFilter(size)
            if all(self.filter.insert(key) for key in self.rows):
                return
            size *= 2

    def add(self, digest: bytes, chars: int, doc_id: int | None, size: int) -> None:
        """Add rows of one text; more code points, then the smaller id, stay (null id last)."""
        better = (chars, doc_id is not None, -(doc_id or 0))
        if digest in self.filter and (row := self.rows.get(digest)) is not None:
            row[2] += size
            if better > row[0]:
                row[0], row[1] = better, doc_id
            return
        self.rows[digest] = [better, doc_id, size]
        self._insert(digest)

    def remove(self, digest: bytes) -> bool:
        """Delete a digest that is no longer live."""
        if digest in self.filter and digest in self.rows:
            del self.rows[digest]
            return self.filter.delete(digest)
        return False


def _bucket(frame: pd.DataFrame) -> pd.DataFrame:
    index = LiveIndex(len(frame))
    ids = [None if i is None else int(i) for i in frame.doc_id]  # text: numbers beside nulls would be doubles
    for digest, chars, doc_id, size in zip(frame.digest, frame.chars, ids, frame["size"]):
        index.add(bytes(digest), int(chars), doc_id, int(size))
    rows = index.rows
    return pd.DataFrame({
        "digest": list(rows), "keep_id": pd.array([r[1] for r in rows.values()], dtype="Int64"),
        "group_size": np.array([r[2] for r in rows.values()], dtype="int64"),
    })


def exact_groups(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal without ASCII white space; null is the empty text. Of equal texts, the
    row with the most code points, then the smallest doc_id stays. Rows that repeat a doc_id
    count in group_size and share the flag of that id; a null doc_id stays only if no other
    row can. Further columns are ignored. An empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length(text).cast("long").alias("chars"),
        F.unhex(F.sha2(F.regexp_replace(text, r"[\x20\x09-\x0D]", ""), 256)).alias("digest"),
    ), "digests")
    best = F.max(F.struct(F.col("chars"), F.bitwise_not("doc_id").alias("order")))  # falls as the id rises
    # Split by a hash of the row first: a text with a third of all rows becomes PARTS rows.
    partial = rows.groupBy("digest", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).alias("part")).agg(
        best.alias("best"), F.count("*").alias("size"))
    buckets = max(1, -(-rows.count() // BUCKET_DIGESTS))
    partial = partial.select(
        "digest", "best.chars", F.bitwise_not("best.order").cast("string").alias("doc_id"), "size",
        F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket"))
    keepers = stored(partial.groupBy("bucket").applyInPandas(
        _bucket, "digest binary, keep_id long, group_size long"), "keepers")
    hot = hot_keys(keepers, "digest", "group_size")
    joined = spread_join(rows, keepers, "digest", hot, F.col("doc_id"))
    return joined.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
