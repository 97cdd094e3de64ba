"""Stacking searches, pages, dates and sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts; columns a part lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_sources(parts: dict[str, DataFrame]) -> DataFrame:
    """Listings of several sources in one table, ids as text."""
    return union_all(
        [
            df.withColumn("source", F.lit(name)).withColumn(
                "listing_id", F.col("listing_id").cast("string")
            )
            for name, df in parts.items()
        ]
    )
