"""Audit of how far each source of a language strays from the others and from its language.

Terms are ranked by count cells: the value of a term depends only on its count in the group
and in the language, so it is found once for each pair of counts.
"""

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bondscope.llm.common import hot_keys, spread_join, stored

LEAST_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
#: Distinct (lang, source, term) from which on a task hands its counts on, asked after each batch.
HELD_TERMS = 400_000
#: Terms are runs of ASCII letters, in lower case, and of all bytes beyond ASCII.
FOLDED = bytes(c if c >= 128 else ord(chr(c).lower()) if chr(c).isalpha() else 32 for c in range(256))
WIDE = "decimal(38,0)"
COUNTS = "lang string, source string, term string, n long, docs long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of occurrences and of documents; at most about HELD_TERMS are held.

    Texts come as UTF-8 bytes.
    """
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def handed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            yield pa.RecordBatch.from_arrays([
                pa.repeat(pa.scalar(lang, pa.string()), len(terms)), pa.repeat(pa.scalar(source, pa.string()), len(terms)),
                pa.array(terms, pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
                pa.array([docs[t] for t in terms], pa.int64()),
            ], ["lang", "source", "term", "n", "docs"])
        held.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            terms = text.translate(FOLDED).split()
            n.update(terms)
            docs.update(set(terms))
        if sum(len(n) for n, _ in held.values()) > HELD_TERMS:
            yield from handed_on()
    yield from handed_on()


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)); exact whatever the counts."""
    return 1 + F.call_function(
        "div", F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)"),
        (total + terms).cast("decimal(20,0)"))


def strayed(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares are at most SCALE + 1, so that the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def _sum(value: Column) -> Column:
    return F.sum(value.cast(WIDE))


def _tables(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept terms of every group with their counts, and the groups with their sums."""
    empty = F.lit("")
    given = docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source", "text")])
    partial = given.withColumn("text", F.col("text").cast("binary")).mapInArrow(_counted, COUNTS)
    counts = stored(partial.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = stored(kept.where(F.col("docs") >= LEAST_DOCS).drop("docs"), "kept")
    rows = stored(counts.drop("docs").join(kept, ["lang", "term"]).select(
        F.struct("lang", "source").alias("group"), "lang", "source", "term", "n", "lang_n"), "rows")
    totals = rows.groupBy("group").agg(F.sum("n").alias("total"), F.count("*").alias("present"))
    langs = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("terms"))
    groups = given.select("lang", "source").distinct().withColumn("group", F.struct("lang", "source"))
    groups = groups.join(totals, "group", "left").join(langs, "lang", "left").na.fill(0)
    zero = F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms"))).otherwise(F.lit(1))
    return rows, stored(groups.withColumn("p0", zero.cast("long")), "groups")


def _top_terms(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The TOP_TERMS terms of each group that stray most above their language."""
    hot = hot_keys(groups, "group", "present")
    cells = rows.groupBy("group", "n", "lang_n").agg(F.count("*").alias("m"))
    cells = spread_join(cells, groups.select("group", "total", "terms", "lang_total"), "group", hot, F.col("n"))
    p = share(F.col("n"), F.col("total"), F.col("terms"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    cells = cells.withColumns({"p": p, "q": q}).where("p > q")
    cells = stored(cells.select(
        "group", F.struct("group", "n", "lang_n").alias("cell"), "m",
        strayed(F.col("p"), F.col("q")).alias("value")), "cells")
    # Equal values are one level. A level has a term at least, so TOP_TERMS levels are enough;
    # the limit by rank reaches the tasks before the shuffle.
    down = Window.partitionBy("group").orderBy(F.desc("value"))
    levels = cells.groupBy("group", "value").agg(F.sum("m").alias("m"))
    levels = levels.withColumn("level", F.row_number().over(down)).where(F.col("level") <= TOP_TERMS)
    before = F.coalesce(F.sum("m").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    levels = levels.withColumn("before", before).where(F.col("before") < TOP_TERMS)
    chosen = stored(cells.join(levels.select("group", "value"), ["group", "value"]), "levels")
    hot = hot_keys(chosen, "cell", "m")
    terms = spread_join(
        rows.withColumn("cell", F.struct("group", "n", "lang_n")).select("cell", "term"),
        chosen.select("cell", "value"), "cell", hot, F.col("term"))
    order = Window.partitionBy("group").orderBy(F.desc("value"), "term")
    ranked = terms.select("cell.group", "term", "value").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= TOP_TERMS).select(
        "group.lang", "group.source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Every source of a language against every other, summed over all kept terms.

    The sum over terms is taken as if the other source had none, for both sides, and put
    right for the terms that both have; no term is expanded for a source that lacks it.
    """
    hot = hot_keys(groups, "group", "present")
    sized = groups.select("group", "total", "terms", "p0")
    shares = spread_join(rows.select("group", "lang", "source", "term", "n"), sized, "group", hot, F.col("term"))
    shares = stored(shares.select(
        "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "p0"), "shares")
    a, b = shares.alias("a"), shares.alias("b")
    both = a.join(b, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.term") == F.col("b.term"))
                  & (F.col("a.source") < F.col("b.source")))
    p_a, a0, p_b, b0 = F.col("a.p"), F.col("a.p0"), F.col("b.p"), F.col("b.p0")

    def mended(p: Column, p0: Column, q: Column, q0: Column) -> Column:
        return (strayed(p, q).cast(WIDE) - strayed(p, q0) - strayed(p0, q) + strayed(p0, q0)).cast(WIDE)

    both = both.groupBy(F.col("a.lang").alias("lang"), F.col("a.source").alias("x"), F.col("b.source").alias("y")).agg(
        _sum(mended(p_a, a0, p_b, b0)).alias("there"), _sum(mended(p_b, b0, p_a, a0)).alias("back"))
    # Distinct shares of a source with the number of its terms; the share of a term it lacks
    # counts V - present times as the first of a pair, and -present times as the second.
    cells = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("m")).withColumn("m_back", F.col("m"))
    lacking = groups.select(
        "lang", "source", F.col("p0").alias("p"), (F.col("terms") - F.col("present")).alias("m"),
        (-F.col("present")).alias("m_back"))
    cells = stored(cells.unionByName(lacking), "shares")
    hot = hot_keys(cells.groupBy("lang").agg(F.count("*").alias("n")), "lang", "n")
    others = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0"))
    alone = spread_join(cells, others, "lang", hot, F.xxhash64("source", "p")).where("source <> other")
    alone = alone.groupBy("lang", F.col("source").alias("x"), F.col("other").alias("y")).agg(
        _sum(strayed(F.col("p"), F.col("q0")).cast(WIDE) * F.col("m")).alias("there"),
        _sum(strayed(F.col("q0"), F.col("p")).cast(WIDE) * F.col("m_back")).alias("back"))
    ways = both.unionByName(alone).select("lang", F.explode(F.array(
        F.struct(F.col("x").alias("source"), F.col("y").alias("item"), F.col("there").alias("part_value")),
        F.struct(F.col("y").alias("source"), F.col("x").alias("item"), F.col("back").alias("part_value")))).alias("w"))
    summed = ways.groupBy("lang", "w.source", "w.item").agg(_sum(F.col("w.part_value")).cast("long").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return summed.select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audited(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value and rank for ``docs`` (text, lang, source).

    Part ``pair`` ranks the other sources of a language, part ``term`` the terms that a
    source has too often, see README. A language keeps the terms of at least LEAST_DOCS of its
    rows. Null text, lang and source are '', which is a language or source of its own; rows
    that repeat are documents of their own. Ties are in UTF-8 order. A group without kept
    terms has pairs of its own value and no terms; a language with one source has no pairs.
    Texts of any length are counted whole. Further columns are ignored, whatever their names.
    An empty table gives an empty result.
    """
    rows, groups = _tables(docs)
    return _pairs(rows, groups).unionByName(_top_terms(rows, groups))
