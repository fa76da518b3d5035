"""Long measurements to one row per key, joined to the sensor records."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bondscope import names
from bondscope.operators.joins import spread_join


def widen(
    qa: DataFrame,
    items: Sequence[str] = names.QA_ITEMS,
    key: Sequence[str] = (names.KEY,),
    item: str = "measure_item",
    value: str = "value",
    order: Sequence[str] = (),
    ignore_nulls: bool = False,
) -> DataFrame:
    """One column per item with the value that comes first in ``order``.

    A single aggregation by key instead of ``pivot``, which shuffles twice: by key and
    item, then by key. Partial aggregation leaves one row per key and task, so a hot key
    costs nothing. One order column keeps the hash aggregate; several need a struct and
    with it a sort aggregate. Without order columns the smallest value is taken, so
    the result stays repeatable. A null that comes first is the result, unless
    ``ignore_nulls`` is set.
    """
    first = _order(order, value)
    if ignore_nulls:
        first = F.when(F.col(value).isNotNull(), first)
    return qa.groupBy(*key).agg(
        *[F.min_by(F.col(value), F.when(F.col(item) == i, first)).alias(i) for i in items]
    )


def _order(order: Sequence[str], value: str) -> Column:
    if not order:
        return F.col(value)
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def lot_view(
    qa: DataFrame,
    motion: DataFrame,
    items: Sequence[str] = names.QA_ITEMS,
    key: Sequence[str] = (names.KEY,),
    item: str = "measure_item",
    value: str = "value",
    order: Sequence[str] = (),
    **spread,
) -> DataFrame:
    """Widened measurements joined to the sensor records: key, items, then sensor columns.

    Filter both inputs to the lots first: a filter does not pass the aggregation.
    """
    wide = widen(qa, items, key, item, value, order)
    others = [c for c in motion.columns if c not in key]
    return spread_join(motion, wide, key, **spread).select(*key, *items, *others)


def ground_truth(
    qa: DataFrame,
    motion: DataFrame,
    items: Sequence[str] = names.QA_ITEMS,
    key: Sequence[str] = (names.KEY,),
    item: str = "measure_item",
    value: str = "value",
    order: Sequence[str] = (),
    repeat_keys: bool = True,
    **spread,
) -> DataFrame:
    """Widened measurements of the keys that have a sensor record.

    A key repeats as often as in the sensor records, or appears once with
    ``repeat_keys=False``.
    """
    wide = widen(qa, items, key, item, value, order)
    if repeat_keys:
        return spread_join(motion.select(*key), wide, key, **spread).select(*key, *items)
    # distinct() first: a hot key reaches the join as one row.
    return wide.join(motion.select(*key).distinct(), list(key), "left_semi")
