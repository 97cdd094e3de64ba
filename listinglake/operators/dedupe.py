"""First-wins de-duplication.

``order`` must identify a row within its key; otherwise "first" is not defined.
Both operators reduce every key to one row per task before shuffling (a partial
group limit for the rank-1 filter, a partial aggregate for the other), so a key
that holds a large share of all rows does not end up in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from listinglake.schemas import ORDER_COLUMNS


def dedupe_first(
    df: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """First row per key."""
    first = W.partitionBy(*keys).orderBy(*(order or ORDER_COLUMNS))
    return (
        df.withColumn("_rn", F.row_number().over(first))
        .filter(F.col("_rn") == 1)
        .drop("_rn")
    )


def dedupe_later_pages(
    df: DataFrame,
    key: str = "listing_id",
    order: list[str] | None = None,
    page: str = "page",
    within: list[str] | None = None,
    slices: int = 64,
) -> DataFrame:
    """Page 1 stays whole, repeats included; later pages only add unseen ids.

    ``within`` names the columns of one search when the table holds several, and
    ``order`` has to start with the page, so the first row of a key is one of page 1 if
    there is any: a row stays if it is on page 1 or the first of its key.

    One pass: rows are ranked inside slices of their key first.  What is neither on page 1
    nor first there goes.  The rest is ranked by key, except for the repeats of page 1:
    they stay in any case, and remain in a lane of their slice, so that a hot key is never
    gathered in one task.
    """
    keys = [*(within or []), key]
    order = order or ORDER_COLUMNS
    on_first = F.col(page) <= 1
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(slices)))

    def ranked(rows: DataFrame, by: str) -> DataFrame:
        rank = F.row_number().over(W.partitionBy(*keys, by).orderBy(*order))
        return rows.withColumn("_rn", rank).filter(on_first | (F.col("_rn") == 1))

    repeat = on_first & (F.col("_rn") > 1)
    lanes = ranked(sliced, "_slice").withColumn(
        "_lane", F.when(repeat, F.col("_slice") + 1).otherwise(0)
    )
    return ranked(lanes, "_lane").drop("_slice", "_lane", "_rn")
