"""Near-duplicate groups by SetSketch registers."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bondscope.llm.common import hot_keys, rows_of, spread_join, stored
from bondscope.storage import handed_over, removed

SHINGLE = 5
THRESHOLD = 75
BASE = 1.001
#: A band is BAND registers. Bands join most similar texts early; the exact search finds the rest.
BAND = 6
BANDS = 16
REGISTERS = BANDS * BAND
#: Hashes that more texts share, by a draw of two in PART texts, go to the end of the order.
PART = 64
#: Such hashes at most (1.6 MB): which ones are taken changes the work, not the links.
LATE = 200_000

ODD = np.random.default_rng(5).integers(1, 2**32, REGISTERS, dtype=np.uint32) | np.uint32(1)
PLACE = np.random.default_rng(6).integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(tokens: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles (of all words, if fewer)."""
    if not tokens:
        return np.empty(0, dtype=np.uint64)
    if len(known) > 200_000:
        known.clear()
    for token in set(tokens).difference(known):
        known[token] = xxhash.xxh3_64_intdigest(token)
    hashes = np.fromiter(map(known.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    width = min(SHINGLE, len(tokens))
    out = np.full(len(tokens) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        part = hashes[i:len(hashes) - width + 1 + i] * PLACE[i]
        out = (out ^ (part ^ (part >> np.uint64(32)))) * MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers: exponentially spaced truncations of the least hash of each function.

    The registers of a union are the maxima of the registers.
    """
    least = np.full(REGISTERS, np.iinfo(np.uint32).max, dtype=np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 1024):
        np.minimum(least, (short[at:at + 1024, None] * ODD[None, :]).min(axis=0), out=least)
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32)
    return np.floor(1 - np.log(exponential) / np.log(BASE)).astype(np.int32)


def least_hashes(hashes: np.ndarray, late: np.ndarray | None = None) -> np.ndarray:
    """The first hashes of a set, in an order that is the same for all sets: ``late`` ones (sorted) last.

    Of n hashes at least 75% are in any similar set, so one of the first n - ceil(0.75 n) + 1 is;
    the first common hash of two similar sets is among these in both.
    """
    first = len(hashes) + (-THRESHOLD * len(hashes) // 100) + 1
    if late is None or not len(late):
        return hashes[:first]
    behind = is_late(hashes, late)
    return np.concatenate([hashes[~behind][:first], hashes[behind]])[:first]


def is_late(hashes: np.ndarray, late: np.ndarray) -> np.ndarray:
    """Which hashes are among the sorted ``late`` ones."""
    if not len(late):
        return np.zeros(len(hashes), dtype=bool)
    return late[np.minimum(np.searchsorted(late, hashes), len(late) - 1)] == hashes


def parity(hashes: np.ndarray) -> np.ndarray:
    """Parities of the numbers of hashes in 2 to 4 buckets a hash: a power of two, at most 2^17.

    Two sets of different parity in a bucket differ in a hash of it. The first half of the
    buckets xor the second half are the parities of half as many buckets.
    """
    size = min(1 << 17, max(64, 1 << (2 * len(hashes)).bit_length()))
    spot = (hashes >> np.uint64(16)) & np.uint64(size - 1)
    return np.packbits((np.bincount(spot.astype(np.int64), minlength=size) & 1).astype(np.uint8))


def most_common(n_a: int, n_b: int, odd_a: bytes, odd_b: bytes) -> int:
    """Hashes that two sets can share at most, by their sizes and parities."""
    a, b = np.frombuffer(odd_a, dtype=np.uint8), np.frombuffer(odd_b, dtype=np.uint8)
    while len(a) > len(b):
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    while len(b) > len(a):
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return (n_a + n_b - int(np.bitwise_count(a ^ b).sum())) // 2


def _sketch(late: np.ndarray):
    """Sizes, digests, first hashes (``rare`` of them not late), bands and parities of whole texts."""

    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, int] = {}
        for frame in frames:
            for at in range(0, len(frame), 500):
                part, out = frame.iloc[at:at + 500], []
                for doc_id, text in zip(part.doc_id, part.text):
                    tokens = words(text)
                    hashes = shingles(tokens, known)
                    same = xxhash.xxh3_128_digest(b" ".join(tokens))
                    if len(hashes):
                        least = least_hashes(hashes, late)
                        rare = int((~is_late(least, late)).sum())
                        sketch = registers(hashes)
                        bands = [xxhash.xxh3_64_intdigest(sketch[i:i + BAND].tobytes(), seed=i) - 2**63 for i in range(0, REGISTERS, BAND)]
                        out.append((doc_id, len(hashes), same, rare, least.view(np.int64), bands, parity(hashes).tobytes()))
                    else:
                        out.append((doc_id, 0, same, 0, None, None, None))
                yield pd.DataFrame(out, columns=["doc_id", "n_shingles", "same", "rare", "least", "bands", "parity"])

    return found


def _hashes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[bytes, int] = {}
    for frame in frames:
        for at in range(0, len(frame), 100):
            found = [shingles(words(text), known) for text in frame.text[at:at + 100]]
            yield pd.DataFrame({"part": np.concatenate(found).view(np.int64)})


def late_hashes(texts: DataFrame) -> np.ndarray:
    """Hashes that two of the drawn texts share, the most frequent ones, LATE at most; sorted.

    They go to the end of the order. The draw decides how much is compared, not what is found.
    """
    drawn = texts.where(F.pmod(F.xxhash64("text"), F.lit(max(1, PART // 2))) == 0).select("text").distinct()
    held = drawn.mapInPandas(_hashes, "part long").groupBy("part").agg(F.count("*").alias("n")).where("n > 1")
    held = stored(held, "frequent")
    least, total = None, 0
    for row in sorted(held.groupBy("n").agg(F.count("*").alias("m")).collect(), reverse=True):
        total += row.m
        if total > LATE:
            break
        least = row.n
    if least is None:
        return np.empty(0, dtype=np.uint64)
    found = [r.part for r in held.where(F.col("n") >= least).select("part").collect()]  # LATE at most
    return np.sort(np.array(found, dtype=np.int64).view(np.uint64))


def _close(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs that the parities of both leave possible: a bound, so no similar pair is lost."""
    for frame in frames:
        most = [most_common(*row) for row in zip(frame.n_a, frame.n_b, frame.odd_a, frame.odd_b)]
        total = frame.n_a + frame.n_b
        yield frame.loc[(100 + THRESHOLD) * np.array(most, dtype=np.int64) >= THRESHOLD * total, ["a", "b"]]


def _confirm(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[bytes, int] = {}
    for frame in frames:
        keep, last = [], {}
        for text_a, text_b in zip(frame.text_a, frame.text_b):
            if len(last) > 64:
                last.clear()
            for text in (text_a, text_b):
                if text not in last:
                    last[text] = shingles(words(text), known)
            left, right = last[text_a], last[text_b]
            both = len(np.intersect1d(left, right, assume_unique=True))
            keep.append(100 * both >= THRESHOLD * (len(left) + len(right) - both))
        yield frame.loc[keep, ["a", "b"]]


def _linked(pairs: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """Of distinct candidate pairs (a, b) those whose full shingle sets are similar enough."""
    pairs = stored(pairs, "pairs")
    hot = hot_keys(pairs.groupBy("b").agg(F.count("*").alias("n")), "b", "n")
    side = reps.select("doc_id", "n_shingles", "parity")
    sized = spread_join(pairs.join(side.toDF("a", "n_a", "odd_a"), "a"), side.toDF("b", "n_b", "odd_b"), "b", hot, F.col("a"))
    sized = sized.where(100 * F.least("n_a", "n_b") >= THRESHOLD * F.greatest("n_a", "n_b"))
    likely = sized.select("a", "b", "n_a", "n_b", "odd_a", "odd_b").mapInPandas(_close, "a long, b long")
    likely = stored(likely.distinct(), "possible")
    hot = hot_keys(likely.groupBy("b").agg(F.count("*").alias("n")), "b", "n")
    ids = stored(likely.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    needed = stored(rows_of(texts, ids).distinct(), "texts")
    full = spread_join(
        likely.join(needed.toDF("a", "text_a"), "a"), needed.toDF("b", "text_b"), "b", hot, F.col("a"))
    return stored(full.select("a", "b", "text_a", "text_b").mapInPandas(_confirm, "a long, b long").distinct(), "links")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Smallest doc_id reachable of every node: (doc_id, component_id).

    Large-star and small-star steps in turn: a node hands its least neighbour first to its
    larger neighbours, then to itself and the smaller ones, until nothing changes. The rounds
    grow with the logarithm of the nodes, not with the length of chains.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n")), "least")
        given = spread_join(both.where("v > u"), least.select("u", "m"), "u", hot_keys(least, "u", "n"), F.col("v"))
        edges = stored(given.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = stored(edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least")
        given = spread_join(edges, least.select("u", "m"), "u", hot_keys(least, "u", "n"), F.col("v"))
        small = given.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = stored(small.where("u <> v").distinct(), "small")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return nodes.select("doc_id").distinct().join(edges.toDF("doc_id", "root"), "doc_id", "left").select(
        "doc_id", F.coalesce("root", "doc_id").alias("component_id"))


def _inside(held: DataFrame) -> DataFrame:
    """Rows of the parts that hold several components.

    Each with the smallest doc_id ``b`` of the part, its component ``cb``, the rows ``n`` and the
    fewest shingles ``low_n`` of the part.
    """
    mixed = stored(held.groupBy("part").agg(
        F.min("doc_id").alias("b"), F.min(F.struct("doc_id", "component_id"))["component_id"].alias("cb"),
        F.count("*").alias("n"), F.min("n_shingles").alias("low_n"),
        F.min("component_id").alias("low"), F.max("component_id").alias("high")
    ).where("low <> high").drop("low", "high"), "mixed")
    return stored(spread_join(held, mixed, "part", hot_keys(mixed, "part", "n"), F.col("doc_id")), "inside")


def _enough(most: Column, n_a: Column, n_b: Column) -> Column:
    """Whether ``most`` common hashes make sets of these sizes similar."""
    return (100 + THRESHOLD) * most >= THRESHOLD * (n_a + n_b)


def _live(inside: DataFrame) -> DataFrame:
    """Rows that can be the first hash which a text shares with a similar one of another component.

    ``left``: the text's rows from there on. All that two sets share lies behind the first one; the
    other set has at least ``low_n`` hashes and three quarters of this one's.
    """
    behind = Window.partitionBy("doc_id", "n_shingles").orderBy(F.col("at").desc())
    n = F.col("n_shingles")
    other = F.greatest("low_n", F.floor(THRESHOLD * n / 100))
    return inside.withColumn("left", F.count("*").over(behind)).where(_enough(n - F.col("at"), n, other))


def _across(inside: DataFrame) -> DataFrame:
    """Distinct pairs of different components that the places of their shared hashes leave possible.

    A part's rows outside the component of its smallest doc_id meet all of its rows, as the first
    hash that two sets share: behind it both have to have enough hashes, and enough of those that are
    not theirs alone, but for the ones behind the first hashes of one of them. The first shared hash
    of a similar pair meets both bounds, so no such pair is lost, and texts that share a passage
    only do not meet by it if their own hashes, which come before, are too many.
    """
    live = stored(_live(inside), "live")
    side = F.struct(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "at", "left")
    here = live.where("component_id <> cb").select("part", side.alias("x"), F.col("component_id").alias("cx"), "cb")
    there = live.select("part", side.alias("y"), F.col("component_id").alias("cy"))
    hot = hot_keys(live.groupBy("part").agg(F.count("*").alias("n")), "part", "n")
    met = spread_join(here, there, "part", hot, F.col("x.id")).where("cx <> cy AND (cy = cb OR cx > cy)")
    n_x, n_y = F.col("x.n"), F.col("y.n")
    rest = F.ceil(THRESHOLD * F.greatest(n_x, n_y) / 100) - 1
    met = met.where((100 * F.least(n_x, n_y) >= THRESHOLD * F.greatest(n_x, n_y))
                    & _enough(F.least(n_x - F.col("x.at"), n_y - F.col("y.at")), n_x, n_y)
                    & _enough(F.least("x.left", "y.left") + rest, n_x, n_y))
    return met.select(F.greatest("x.id", "y.id").alias("a"), F.least("x.id", "y.id").alias("b")).distinct()


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text).

    Sets of distinct five-word shingles are linked from a Jaccard similarity of 0.75; a text
    with fewer words is one shingle, without words it has none and no links. Equal word
    sequences are one class, so copies are never paired. In each band bucket of the registers
    all classes are compared with the smallest one, which joins most similar texts. The rest
    is exact: two similar sets share one of their first hashes (``least_hashes``), so all pairs
    that share one and are not yet of one component are candidates. Hashes of many texts, such
    as those of a common passage, come last in that order. Candidates pass a size bound, bounds
    by the place of the first shared hash, one by the parities of both sets, and the exact
    test on full sets; no link is lost.

    Rows that repeat a doc_id with other texts count as one node of the graph. A null doc_id
    has a null component_id and stays. Further columns are ignored; no rows give no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Ids travel as text: numbers beside nulls would pass through doubles.
    sketches = texts.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        _sketch(late_hashes(texts)),
        "doc_id string, n_shingles long, same binary, rare int, least array<long>, bands array<long>, parity binary")
    sketches, path = handed_over(sketches.withColumn("doc_id", F.col("doc_id").cast("long")), "sketches")
    rows = stored(sketches.select("doc_id", "n_shingles", "same"), "rows")
    known = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = stored(known.groupBy("same").agg(
        F.min(F.struct("doc_id", "n_shingles", "rare", "least", "bands", "parity")).alias("rep"), F.count("*").alias("n")
    ).select("same", "rep.*", "n"), "reps")
    removed(docs.sparkSession, path)
    inside = _inside(reps.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.explode("bands").alias("part")))
    # Each text with the smallest one beside it.
    star = inside.where("component_id <> cb").groupBy(F.col("doc_id").alias("a")).agg(F.min("b").alias("b"))
    links = _linked(star, reps, texts)
    found = stored(components(reps, links), "components")
    first = reps.select("doc_id", "n_shingles", "rare", F.posexplode("least").alias("at", "part"))
    # Most hashes are of one text alone: they move once. Late ones are of many, and never meet in one task.
    few = first.where("at < rare").drop("rare").withColumn("n", F.count("*").over(Window.partitionBy("part")))
    shared = few.where("n > 1").drop("n").union(first.where("at >= rare").drop("rare"))
    new = _linked(_across(_inside(stored(shared.join(found, "doc_id"), "shared"))), reps, texts)
    if not new.isEmpty():
        found = stored(components(reps, stored(links.union(new), "all-links")), "components")
    classes = reps.select("same", F.col("doc_id").alias("rep"), "n")
    # All rows of a class share the component of its first row; ids repeated with other texts join classes.
    member = classes.join(found, classes.rep == found.doc_id).select("same", "component_id", "n")
    hot = hot_keys(classes, "same", "n")
    alone = F.col("n_shingles") == 0
    named = spread_join(rows.where(~alone & F.col("doc_id").isNotNull()), member.drop("n"), "same", hot, F.col("doc_id"))
    out = named.select("doc_id", "n_shingles", "component_id").union(
        rows.where(alone | F.col("doc_id").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
