"""Stable ordering, caps and top-k reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from listinglake.operators.offers import FIRST_SEEN
from listinglake.schemas import ORDER_COLUMNS
from listinglake.session import settled

def check_cap(n: int) -> None:
    if n < 0:
        raise ValueError("cap must not be negative")


def sort_by_price(
    df: DataFrame, price: str = "total_price", ties: str = FIRST_SEEN
) -> DataFrame:
    """Ascending price, unknown prices last, ties in first-seen order."""
    return df.orderBy(F.col(price).asc_nulls_last(), ties)


def cap(df: DataFrame, n: int, order: list[str] | None = None) -> DataFrame:
    """First ``n`` rows in source order; planned as a distributed top-n."""
    check_cap(n)
    return df.orderBy(*(order or ORDER_COLUMNS)).limit(n)


def cap_by_price(
    df: DataFrame, n: int, price: str = "total_price", ties: str = FIRST_SEEN
) -> DataFrame:
    check_cap(n)
    return sort_by_price(df, price, ties).limit(n)


def cap_per_group(
    df: DataFrame, keys: list[str], n: int, order: list[str] | None = None, salts: int = 64
) -> DataFrame:
    """First ``n`` rows of every group.

    Groups are first cut inside salted slices, which keeps the result exact (a row in
    the first ``n`` of its group is in the first ``n`` of its slice) while no task ever
    sorts a whole hot group.
    """
    check_cap(n)
    order = order or ORDER_COLUMNS

    def cut(rows: DataFrame, by: list[str]) -> DataFrame:
        position = F.row_number().over(W.partitionBy(*by).orderBy(*order))
        return rows.withColumn("_rn", position).filter(F.col("_rn") <= n).drop("_rn")

    df = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    return cut(cut(df, [*keys, "_salt"]).drop("_salt"), keys)


def sort_by_rate(
    df: DataFrame, rate: str = "rate", ties: str = "listing_id"
) -> DataFrame:
    return df.orderBy(F.col(rate), ties)


def top_and_honorable(
    df: DataFrame,
    top_n: int,
    honorable_n: int,
    min_reviews: int,
    price: str = "total_price",
    ties: str = "listing_id",
) -> tuple[DataFrame, DataFrame]:
    """(well reviewed, little or no reviews), each the cheapest ``n``."""
    reviews = F.coalesce(F.col("review_count"), F.lit(0))
    return (
        cap_by_price(df.filter(reviews >= min_reviews), top_n, price, ties),
        cap_by_price(df.filter(reviews < min_reviews), honorable_n, price, ties),
    )


def with_rank(
    df: DataFrame, order: list[str], n: int | None = None, rank: str = "Rank"
) -> DataFrame:
    """All rows numbered from 1 in ``order``, or the first ``n`` of them.

    Rows are dealt to tasks by ranges of the order and written, so that the ranges
    stay as they are; each is numbered by itself, behind the rows of the ranges before
    it.  Only the table of range sizes, a row for each task, is ordered as a whole.
    """
    if n is not None:
        return cap(df, n, order).withColumn(rank, F.row_number().over(W.orderBy(*order)))
    dealt = settled(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranked"
    )
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_n"))
    within = F.row_number().over(W.partitionBy("_range").orderBy(*order))
    return (
        dealt.withColumn("_at", within)
        .join(F.broadcast(offsets), "_range")
        .withColumn(rank, (F.col("_n") + F.col("_at")).cast("int"))
        .drop("_range", "_n", "_at")
    )
