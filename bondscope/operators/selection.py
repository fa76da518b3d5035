"""The n-th row in an order over any columns, without sorting all rows.

Each pass draws some of the rows that are still possible, takes two of them that most likely
enclose the n-th, and counts the rows up to each. What is left is some percent of what was
there; only the last small range is sorted. The draw affects the number of passes
and nothing else: counts are exact, and the answer is the same at any size.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, isnan, sqrt

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of the last range, which is sorted, and rows drawn in one pass.
SORTED_ROWS = 100_000
DRAWN_ROWS = 10_000


def _carried(kind: T.DataType):
    """To and from a value that a driver keeps exactly, whatever the time zones."""
    if isinstance(kind, T.TimestampNTZType):
        zero = F.lit("1970-01-01").cast("timestamp_ntz")
        return (lambda c: F.timestamp_diff("MICROSECOND", zero, c),
                lambda x: F.timestamp_add("MICROSECOND", F.lit(x).cast("long"), zero))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros, lambda x: F.timestamp_micros(F.lit(x).cast("long"))
    if isinstance(kind, T.DateType):
        return F.unix_date, lambda x: F.date_from_unix_date(F.lit(x).cast("int"))
    return lambda c: c, lambda x: F.lit(x).cast(kind)


@dataclass(frozen=True)
class Place:
    """A row's place: ``first`` descending with nulls last, then ``then`` ascending, nulls first.

    NaN is above all numbers. It is asked for by name, as the least and greatest values that
    a store keeps of its parts leave it out.
    """

    first: str
    first_value: Column
    known: bool
    floating: bool
    is_nan: bool
    then: tuple[str, ...]
    then_values: tuple[Column, ...]

    def _keys(self) -> tuple[Column, Column]:
        return (F.struct(*[F.col(c) for c in self.then]),
                F.struct(*[v.alias(c) for c, v in zip(self.then, self.then_values)]))

    def _nan(self) -> Column:
        return F.coalesce(F.isnan(self.first), F.lit(False)) if self.floating else F.lit(False)

    def _same(self) -> Column:
        return self._nan() if self.is_nan else F.col(self.first).eqNullSafe(self.first_value)

    def before(self) -> Column:
        """Whether a row comes before this place."""
        mine, its = self._keys()
        if not self.known:
            return F.col(self.first).isNotNull() | (mine < its)
        above = F.coalesce(F.col(self.first) > self.first_value, F.lit(False)) | self._nan()
        return (self._same() & (mine < its)) | (F.lit(False) if self.is_nan else above)

    def at(self) -> Column:
        mine, its = self._keys()
        return self._same() & mine.eqNullSafe(its)

    def reach(self) -> Column:
        """A plain predicate that holds up to this place and reaches the file scan."""
        if not self.known:
            return F.lit(True)
        if self.floating:
            return self._nan() if self.is_nan else (F.col(self.first) >= self.first_value) | self._nan()
        return F.col(self.first) >= self.first_value


def _place(row: Row, df: DataFrame, first: str, then: Sequence[str]) -> Place:
    values = [_carried(df.schema[c].dataType)[1](row[i]) for i, c in enumerate([first, *then])]
    floating = isinstance(df.schema[first].dataType, (T.FloatType, T.DoubleType))
    return Place(first, values[0], row[0] is not None, floating, floating and row[0] is not None and isnan(row[0]),
                 tuple(then), tuple(values[1:]))


def _ordered(df: DataFrame, first: str, then: Sequence[str]) -> DataFrame:
    return df.orderBy(F.col(first).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in then])


def _rows(df: DataFrame, first: str, then: Sequence[str]) -> DataFrame:
    carried = [_carried(df.schema[c].dataType)[0](F.col(c)).alias(f"_{i}") for i, c in enumerate([first, *then])]
    return df.select(*carried)


def nth_place(df: DataFrame, n: int, first: str, then: Sequence[str], rows: int, most: int) -> tuple[Place, int, int]:
    """Place of the n-th of ``rows`` rows, the number of rows before it, and of rows at it."""
    left, skipped, inside = df.select(first, *[c for c in then if c != first]), 0, rows
    while True:
        if inside <= most:
            row = _rows(_ordered(left, first, then), first, then).offset(n - skipped - 1).limit(1).first()
            place = _place(row, df, first, then)
            before, at = left.agg(F.count_if(place.before()), F.count_if(place.at())).first()
            return place, skipped + before, at
        drawn = left.sample(min(1.0, DRAWN_ROWS / inside), seed=inside % 1_000_003)
        drawn = _rows(_ordered(drawn, first, then), first, then).collect()  # about DRAWN_ROWS keys
        drawn = drawn or _rows(left.limit(1), first, then).collect()
        about, wide = (n - skipped) / inside * len(drawn), 3 * sqrt(len(drawn)) / 2 + 1
        picks = [min(max(int(x), 0), len(drawn) - 1) for x in (about - wide, about, ceil(about + wide))]
        low, middle, high = (_place(drawn[i], df, first, then) for i in picks)
        counts = left.agg(*[F.count_if(c) for p in (low, middle, high) for c in (p.before(), p.at())]).first()
        wanted = n - skipped
        upto = {name: (counts[2 * i], counts[2 * i] + counts[2 * i + 1]) for i, name in enumerate(("low", "middle", "high"))}
        if upto["middle"][0] < wanted <= upto["middle"][1]:
            return middle, skipped + upto["middle"][0], counts[3]
        # The middle row is left out in any case, so every pass gets nearer.
        if wanted <= upto["middle"][0]:
            left = left.where(middle.reach()).where(middle.before())
            inside = upto["middle"][0]
            if wanted > upto["low"][1]:
                left, skipped, inside = left.where(~(low.before() | low.at())), skipped + upto["low"][1], inside - upto["low"][1]
        else:
            left = left.where(~(middle.before() | middle.at()))
            skipped, inside, passed = skipped + upto["middle"][1], inside - upto["middle"][1], upto["middle"][1]
            if wanted <= upto["high"][1] and upto["high"][1] > passed:
                left = left.where(high.reach()).where(high.before() | high.at())
                inside = upto["high"][1] - passed


def first_in_order(df: DataFrame, n: int, first: str, then: Sequence[str], most: int | None = None) -> DataFrame:
    """The n first rows by ``first`` (descending, nulls last), then ``then`` (ascending, nulls first).

    The rows are chosen by a filter that reaches the file scan. Of rows that share the last
    place, copies in these columns, the first by the remaining orderable columns are taken.
    """
    rows = df.count()
    if n >= rows:
        return df
    if n <= 0:
        return df.limit(0)
    place, before, at = nth_place(df, n, first, list(then), rows, SORTED_ROWS if most is None else most)
    reached = df.where(place.reach())
    if before + at == n:
        return reached.where(place.before() | place.at())
    unordered = (T.MapType, T.VariantType)
    rest = [f.name for f in df.schema if f.name not in (first, *then) and not isinstance(f.dataType, unordered)]
    equal = reached.where(place.at())
    equal = equal.orderBy(*[F.col(f"`{c}`") for c in rest]) if rest else equal
    return reached.where(place.before()).unionByName(equal.limit(n - before))
