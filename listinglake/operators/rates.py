"""Weekly rates: child tables and the rate of one target week."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listinglake.operators.dedupe import dedupe_first


def child_rows(details: DataFrame, column: str, key: str = "listing_id") -> DataFrame:
    """A list column as rows: key, ``pos``, then the list's fields."""
    item = details.schema[column].dataType.elementType
    rows = details.select(key, F.posexplode(column).alias("pos", "_item"))
    if item.typeName() == "struct":
        return rows.select(key, "pos", "_item.*")
    return rows.withColumnRenamed("_item", "value")


def first_week(
    rates: DataFrame,
    week: Column,
    key: str = "listing_id",
    order: list[str] | None = None,
) -> DataFrame:
    """First rate entry per listing whose date is the target week."""
    return dedupe_first(rates.filter(week), [key], order or ["pos"])


def week_of_list(weeks: Column, date_field: str, target: str | Column) -> Column:
    """First entry of a list column whose date is the target, null if none."""
    return F.get(F.filter(weeks, lambda w: w[date_field] == target), F.lit(0))


def available_week(
    rates: DataFrame,
    target: str,
    arrive: str = "arrive",
    open_flag: str | None = "is_available",
    rate: str = "weekly_rate",
    order: list[str] | None = None,
) -> DataFrame:
    """Per listing the target week's first entry, if it is open and priced."""
    first = first_week(rates, F.col(arrive) == target, order=order)
    if open_flag:
        first = first.filter(F.col(open_flag))
    return first.filter(F.col(rate).isNotNull())
