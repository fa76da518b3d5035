"""Train and test split by a hash of the key."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bondscope import names
from bondscope.operators.ranks import chunker, order_statistic, ranked_values

# Fixed value: share of test rows.
TEST_SHARE = 0.2


def key_hash(key: Sequence[str]) -> Column:
    """MD5 of the key columns, joined by a bar."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key]))


def in_test(key: Sequence[str], share: float = TEST_SHARE) -> Column:
    """Whether the key belongs to the test rows: about ``share`` of the keys.

    It depends on the key alone, so it is the same for any layout, run and retry.
    """
    return key_hash(key) < F.lit(format(int(share * 16**8), "08x"))


def split(
    df: DataFrame,
    key: Sequence[str] = (names.KEY,),
    share: float = TEST_SHARE,
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by hash; no shuffle."""
    return df.where(~in_test(key, share)), df.where(in_test(key, share))


def exact_split(
    df: DataFrame,
    key: Sequence[str] = (names.KEY,),
    share: float = TEST_SHARE,
    chunks: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows with exactly the ceiling of ``share`` of the rows as test rows.

    The test rows are those with the smallest hashes. The hash of the last one comes from
    distributed ranks, so nothing is sorted in one task. Repeats of a key stay together.
    """
    # 13 hexadecimal digits fit a double exactly.
    place = F.conv(F.substring(key_hash(key), 1, 13), 16, 10).cast("double")
    places = df.select(place.alias("x"))
    wanted = F.ceil(F.col("n_total") * F.lit(share)) - 1
    last = ranked_values(places, ["x"], chunker(places, ["x"], chunks)).agg(
        order_statistic(wanted).alias("last")
    )
    edge = F.coalesce(last.scalar(), F.lit(-1.0))
    return df.where(place > edge), df.where(place <= edge)
