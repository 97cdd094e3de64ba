"""Cheapest offer per listing over many check-in dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIRST_SEEN = "first_seen"


def cheapest_offer(
    df: DataFrame,
    order: list[str],
    key: str = "listing_id",
    price: str = "total_price",
) -> DataFrame:
    """One row per listing: a known price beats none, lower beats higher, and on a
    tie the row that comes first in ``order`` stays.

    ``first_seen`` holds the listing's first position over all its rows; it breaks
    ties when the result is sorted.  An aggregate rather than a window, so every
    task sends at most one row per listing into the shuffle.
    """
    position = F.struct(*order)
    rank = F.struct(F.col(price).isNull(), F.col(price), position)
    best = df.groupBy(key).agg(
        F.min_by(F.struct(*df.columns), rank).alias("_best"),
        F.min(position).alias(FIRST_SEEN),
    )
    return best.select("_best.*", FIRST_SEEN)


def first_search_area(
    df: DataFrame, order: list[str], area: str = "search_area"
) -> DataFrame:
    """First non-empty area label in ``order``; '' when there is none."""
    return df.agg(
        F.coalesce(
            F.min_by(F.when(F.col(area) != "", F.col(area)), F.when(
                F.col(area) != "", F.struct(*order))),
            F.lit(""),
        ).alias(area)
    )
