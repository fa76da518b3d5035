"""Tables laid out for the joins and filters of the workflows, in the session's own catalog.

A table is partitioned by day, so that a choice of lots reads only their days, and bucketed and
sorted by the key, so that joins and aggregations by the key need no shuffle.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondscope import names

BUCKETS = 64


def save_laid_out(
    df: DataFrame,
    table: str,
    key: str = names.KEY,
    date: str = names.DATE,
    buckets: int = BUCKETS,
    mode: str = "overwrite",
) -> None:
    """Write a catalog table, partitioned by ``date`` and bucketed by ``key``.

    Rows are dealt by day and bucket first, so that each bucket of a day is one file. Tables
    that are joined need the same number of buckets.
    """
    dealt = df.repartition(buckets, F.col(key)).sortWithinPartitions(date, key)
    dealt.write.mode(mode).partitionBy(date).bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)


def chosen_lots(
    spark: SparkSession,
    table: str,
    pairs: Sequence[tuple],
    date: str = names.DATE,
    lot: str = names.LOT,
) -> DataFrame:
    """Rows of the distinct (date, lot) pairs; only the folders of their days are read.

    A literal filter, not a join, so that the buckets of the table stay known.
    """
    df = spark.table(table)
    kinds = {c: df.schema[c].dataType for c in (date, lot)}
    wanted = F.lit(False)
    for day, name in dict.fromkeys((str(d), str(i)) for d, i in pairs):
        wanted = wanted | ((F.col(date) == F.lit(day).cast(kinds[date])) & (F.col(lot) == F.lit(name).cast(kinds[lot])))
    days = [F.lit(d).cast(kinds[date]) for d in sorted({str(d) for d, _ in pairs})]
    return df.where(F.col(date).isin(days)).where(wanted)


def lot_view(
    qa: DataFrame,
    motion: DataFrame,
    items: Sequence[str] = names.QA_ITEMS,
    key: str = names.KEY,
    order: Sequence[str] = (),
) -> DataFrame:
    """The widened measurements joined to the sensor records of tables from ``save_laid_out``.

    Both sides come in buckets of the key, so neither the widening nor the join shuffles. A
    key that fills a bucket by itself belongs into ``wide.lot_view``, which spreads it.
    """
    from bondscope.operators.wide import widen

    others = [c for c in motion.columns if c != key]
    joined = motion.join(widen(qa, items, [key], order=order).hint("merge"), key)
    return joined.select(key, *items, *others)
