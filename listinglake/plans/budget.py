"""Which large homes are free in one target week and within budget.

Three variants, by where a source keeps the price of the week.  Each returns the
in-budget rows (cheapest first) and the funnel counts per town.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions.dates import us_date
from listinglake.functions.numbers import dollar_amount
from listinglake.functions.text import strip
from listinglake.operators.filters import filter_budget, filter_min_bedrooms
from listinglake.operators.joins import join_unique, merge_details
from listinglake.operators.rates import first_week
from listinglake.operators.summary import town_funnel
from listinglake.operators.topk import cap_per_group, sort_by_rate


@dataclass(frozen=True)
class BudgetResult:
    in_budget: DataFrame
    funnel: DataFrame


def _town_names(towns: list[str]) -> list[str]:
    """Both spellings of each town, as listings hold its slug or its display name."""
    names = set()
    for asked in (t.strip().lower() for t in towns):
        names.add(asked)
        for _, slug, _, display in fv.TOWNS:
            if asked in (slug, display.lower()):
                names |= {slug, display.lower()}
    return sorted(names)


def large_homes(
    listings: DataFrame,
    towns: list[str] | None,
    min_bedrooms: int,
    max_per_town: int | None,
) -> DataFrame:
    """Union of the per-town searches, as one scan; a search may have a cap."""
    if towns:
        listings = listings.filter(F.lower(strip(F.col("town"))).isin(_town_names(towns)))
    homes = filter_min_bedrooms(listings, min_bedrooms)
    if max_per_town is None:
        return homes
    return cap_per_group(homes, ["town"], max_per_town)


def _finish(rows: DataFrame, max_rate: float) -> BudgetResult:
    priced = F.col("rate").isNotNull()
    affordable = priced & (F.col("rate") <= max_rate)
    return BudgetResult(
        sort_by_rate(filter_budget(rows, max_rate)),
        town_funnel(rows, priced, affordable),
    )


def _with_week(homes: DataFrame, rates: DataFrame, week: Column, columns: list) -> DataFrame:
    """Homes with the first entry of the target week; homes without one keep nulls."""
    first = first_week(rates, week).select("listing_id", *columns)
    return join_unique(homes, first, "listing_id", "left")


def week_budget_display_rate(
    listings: DataFrame,
    details: DataFrame,
    rates: DataFrame,
    target: str,
    towns: list[str] | None = None,
    min_bedrooms: int = fv.BUDGET_MIN_BEDROOMS,
    max_rate: float = fv.BUDGET_MAX_RATE,
    max_per_town: int | None = None,
) -> BudgetResult:
    """Rates are display texts ("$4,690.00"); a null one means booked.

    ``target`` is an ISO date, the rate rows carry ``M/d/yyyy``.
    """
    homes = merge_details(
        large_homes(listings, towns, min_bedrooms, max_per_town), details, ["sleeps"],
        how="left",
    )
    week = us_date(F.col("arrival_date")) == F.lit(target).cast("date")
    rows = _with_week(
        homes,
        rates,
        week,
        [
            dollar_amount(F.col("weekly_rate")).alias("rate"),
            F.col("weekly_rate").alias("rate_display"),
            "book_type",
        ],
    )
    return _finish(rows, max_rate)


def week_budget_open_flag(
    listings: DataFrame,
    details: DataFrame,
    rates: DataFrame,
    target: str,
    towns: list[str] | None = None,
    min_bedrooms: int = fv.BUDGET_MIN_BEDROOMS,
    max_rate: float = fv.BUDGET_MAX_RATE,
    max_per_town: int | None = None,
) -> BudgetResult:
    """Rates are numbers with an availability flag.

    The first entry of the week decides: when that one is closed, a later open
    entry does not count.
    """
    homes = merge_details(
        large_homes(listings, towns, min_bedrooms, max_per_town),
        details,
        ["bathrooms_full", "bathrooms_half"],
        how="left",
    )
    rows = _with_week(
        homes,
        rates,
        F.col("arrive") == target,
        [
            F.when(F.col("is_available"), F.col("weekly_rate")).alias("rate"),
            F.col("week_content").alias("rate_display"),
        ],
    )
    return _finish(rows, max_rate)


def week_budget_listing_rate(
    listings: DataFrame,
    target: str,
    towns: list[str] | None = None,
    min_bedrooms: int = fv.BUDGET_MIN_BEDROOMS,
    max_rate: float = fv.BUDGET_MAX_RATE,
    max_per_town: int | None = None,
) -> BudgetResult:
    """The listing row already carries the rate of its check-in week."""
    homes = large_homes(
        listings.filter(F.col("check_in") == target), towns, min_bedrooms, max_per_town
    )
    rows = homes.withColumn("village", F.col("town")).withColumnRenamed(
        "weekly_rate", "rate"
    )
    return _finish(rows, max_rate)
