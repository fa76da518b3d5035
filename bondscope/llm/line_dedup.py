"""Line deduplication by a log-template tree of fixed depth."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bondscope.llm.common import SPACES, hot_keys, spread_join, stored
from bondscope.storage import handed_over, removed

LEADING = 3
LEAST_DOCS = 5
COMMON = 0.5
FIELD = "<*>"
#: Leaves (two longs each) that are broadcast at most; more are joined by a shuffle.
SMALL = 200_000


def fields(text: Column) -> Column:
    """The text with every token that has a digit as a variable field."""
    return F.regexp_replace(text, r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+", FIELD)


def tokens(line: Column) -> Column:
    """Tokens of a line. A split at one plain character needs no regular expression."""
    cut = F.when(line.rlike(r"[\x09-\x0D]"), F.split(line, SPACES)).otherwise(F.split(line, " "))
    return F.array_remove(cut, "")


def without_recurring_lines(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped and text_kept of every row of ``docs`` (doc_id, text).

    A leaf of the tree is a token count and the LEADING first tokens. Within a leaf with
    enough lines, a token that at least COMMON of its lines have at that position is fixed,
    others are variable fields; a template with fewer fixed than variable tokens is the line
    itself. Lines whose template occurs in ``least_docs`` documents are dropped. Blank lines
    count as lines and stay. Null texts have no lines and text_kept null. Rows that repeat
    doc_id and text are separate rows and count as one document. Further columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("key", F.xxhash64("doc_id", "text"))
    lines = rows.dropDuplicates(["key"]).select("key", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    # The test for blank lines reads the line, as one of the tokens would split it once more.
    lines = lines.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).withColumn(
        "line", F.when(F.col("line").rlike("[0-9]"), fields(F.col("line"))).otherwise(F.col("line")))
    # Each line is masked and split once; those of common leaves, a small part, are split again.
    split = tokens(F.col("line"))
    lines, path = handed_over(
        lines.withColumn("leaf", F.xxhash64(F.size(split), F.slice(split, 1, LEADING))), "masked")
    leaves = stored(lines.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= least_docs), "leaves")
    hot = hot_keys(leaves, "leaf", "n")
    few = leaves.count() <= SMALL
    inside = lines.join(F.broadcast(leaves), "leaf") if few else spread_join(lines, leaves, "leaf", hot, F.xxhash64("key", "at"))
    inside = stored(inside.withColumn("tokens", tokens(F.col("line"))).drop("line"), "lines")
    removed(docs.sparkSession, path)
    spots = inside.select("leaf", "n", F.posexplode("tokens").alias("place", "token"))
    fixed = spots.groupBy("leaf", "place", "token").agg(F.count("*").alias("m"), F.first("n").alias("n")).where(
        F.col("m") >= F.col("n") * COMMON)
    # At most 1 / COMMON tokens for each place of a leaf.
    fixed = fixed.groupBy("leaf").agg(F.collect_set(F.concat_ws(" ", "place", "token")).alias("fixed"))
    marked = spread_join(inside, fixed, "leaf", hot, F.xxhash64("key", "at"), "left")
    general = F.transform("tokens", lambda w, i: F.when(
        F.array_contains("fixed", F.concat_ws(" ", i, w)), w).otherwise(FIELD))
    marked = marked.withColumn("general", general)
    variable = F.size(F.filter("general", lambda w: w == FIELD))
    template = F.when(2 * variable > F.size("tokens"), F.col("tokens")).otherwise(F.coalesce("general", "tokens"))
    marked = stored(marked.select("key", "at", F.xxhash64("leaf", template).alias("template")), "templates")
    seen = marked.groupBy("template", "key").agg(F.count("*").alias("m")).groupBy("template").agg(
        F.count("*").alias("docs"), F.sum("m").alias("n")).where(F.col("docs") >= least_docs)
    seen = stored(seen, "recurring")
    dropped = spread_join(marked, seen.select("template"), "template", hot_keys(seen, "template", "n"), F.xxhash64("key", "at"))
    dropped = dropped.groupBy("key").agg(F.collect_set("at").alias("gone"))
    joined = rows.join(dropped, "key", "left").withColumn("lines", F.split("text", "\n"))
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    return joined.select(
        "doc_id", F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_dropped"),
        F.array_join(F.filter("lines", lambda _, i: ~F.array_contains(gone, i)), "\n").alias("text_kept")
    ).withColumn("n_lines", F.when(F.col("text_kept").isNull(), 0).otherwise(F.col("n_lines")).cast("long"))
