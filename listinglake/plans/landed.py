"""Searches that read the landing folder of the asked town or date only.

The other searches take a whole source's parsed rows; these take the landing table of
``sources.landing_store`` and test the request key first.  What was landed for a town is
what the site answered for it, so rows are not tested for their town again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions.dates import resolve_stay
from listinglake.operators import filters
from listinglake.operators.offers import cheapest_offer
from listinglake.operators.paging import cap_in_page_order
from listinglake.operators.topk import cap, cap_by_price, cap_per_group
from listinglake.plans.normalize import search_tables
from listinglake.plans.search import SearchResult, in_area, result, stay_candidates
from listinglake.schemas import ORDER_COLUMNS
from listinglake.sources.dims import check_town
from listinglake.sources.landing import newest_landed
from listinglake.sources.landing_store import asked, stretches


def _pages(folder: DataFrame, source: str) -> Callable[[int], DataFrame]:
    """The parsed rows of one stretch of a folder's pages."""
    return lambda n: search_tables(folder.filter(F.col("stretch") == n), source).rows


def search_village(
    landing: DataFrame,
    town: str,
    min_bedrooms: int = 0,
    max_results: int = fv.DEFAULT_CAP,
    check_in: str = "",
    strict: bool = False,
) -> SearchResult:
    """Homes of one village, page by page until there are enough.

    Repeats inside page 1 stay, as on the site; ``strict`` drops those too.
    """
    slug, _ = check_town(fv.SURFORSOUND, town)
    folder = newest_landed(asked(landing, fv.SURFORSOUND, area=slug, check_in=check_in), "search")
    rows = cap_in_page_order(
        _pages(folder, fv.SURFORSOUND),
        stretches(folder),
        max_results,
        ["listing_id"],
        lambda found: filters.filter_min_bedrooms(found, min_bedrooms),
        whole_first_page=not strict,
    )
    return result(rows, "surforsound_listing", slug.title() + fv.SURFORSOUND_AREA_SUFFIX)


def _town_rows(landing: DataFrame, source: str, area: str, min_bedrooms: int) -> DataFrame:
    rows = search_tables(asked(landing, source, area=area), source).rows
    return filters.filter_min_bedrooms(rows, min_bedrooms)


def search_sunrealty_town(
    landing: DataFrame, town: str, min_bedrooms: int = 0, max_results: int = fv.DEFAULT_CAP
) -> SearchResult:
    """Homes of one town; the site is asked by display name."""
    _, display = check_town(fv.SUNREALTY, town)
    rows = cap(_town_rows(landing, fv.SUNREALTY, display, min_bedrooms), max_results)
    return result(rows, "sunrealty_listing", display + fv.SUNREALTY_AREA_SUFFIX)


def search_twiddy_town(
    landing: DataFrame, town: str, min_bedrooms: int = 0, max_results: int = fv.DEFAULT_CAP
) -> SearchResult:
    slug, display = check_town(fv.TWIDDY, town)
    rows = cap(_town_rows(landing, fv.TWIDDY, slug, min_bedrooms), max_results)
    return result(rows, "twiddy_listing", display + fv.TWIDDY_AREA_SUFFIX)


def search_carolinadesigns_town(
    landing: DataFrame,
    town: str,
    min_bedrooms: int = 0,
    max_results: int = fv.DEFAULT_CAP,
    title: str | None = None,
) -> SearchResult:
    slug, _ = check_town(fv.CAROLINADESIGNS, town)
    rows = cap(_town_rows(landing, fv.CAROLINADESIGNS, slug, min_bedrooms), max_results)
    return result(rows, "carolinadesigns_listing", (title or "").strip() or town.title())


def search_stays_landed(
    landing: DataFrame,
    *,
    check_in: str,
    check_out: str | None = None,
    nights: int | None = None,
    place: dict | None = None,
    area: str = "",
    min_bedrooms: int = 0,
    min_bathrooms: float = 0,
    price_min: float = 0,
    price_max: float = 0,
    max_results: int = fv.DEFAULT_CAP,
) -> SearchResult:
    """Stays for one arrival date, page by page until there are enough."""
    first, _, count = resolve_stay(check_in, check_out, nights)
    folder = asked(landing, fv.STAYS, check_in=first).filter(F.col("nights") == count)
    folder = newest_landed(folder, "search")

    def rows_of(stretch: int) -> DataFrame:
        rows = in_area(_pages(folder, fv.STAYS)(stretch), place)
        if min_bedrooms:
            rows = filters.filter_min_bedrooms(rows, min_bedrooms)
        return rows.filter(F.col("bathrooms") >= min_bathrooms) if min_bathrooms else rows

    rows = cap_in_page_order(
        rows_of,
        stretches(folder),
        max_results,
        ["listing_id"],
        # Behind the repeats: an over-priced first copy hides a later one.
        lambda found: filters.filter_nightly_price(found, price_min, price_max),
    )
    return result(rows, "stays_listing", place["display_name"] if place else area)


def search_stays_on_asked_dates(
    landing: DataFrame,
    dates: DataFrame,
    nights: int,
    *,
    place: dict | None = None,
    area: str = "",
    min_bedrooms: int = 0,
    min_bathrooms: float = 0,
    price_min: float = 0,
    price_max: float = 0,
    max_results: int = fv.DEFAULT_CAP,
) -> SearchResult:
    """Stays over all arrival dates of a table (check_in DATE, nights), each at its cheapest.

    The dates come from data, so no plan knows them beforehand: the join with the table
    prunes the date folders when the query runs.  Earlier dates win ties.
    """
    if not nights:
        raise ValueError("nights is required")
    wanted = dates.filter(F.col("nights") == nights).select("check_in").distinct()
    folder = asked(landing, fv.STAYS).filter(F.col("nights") == nights)
    folder = folder.join(wanted, "check_in", "left_semi").select(*landing.columns)
    rows = search_tables(folder, fv.STAYS).rows
    rows = stay_candidates(rows, place, min_bedrooms, min_bathrooms, price_min, price_max)
    per_date = cap_per_group(rows, ["check_in"], max_results)
    merged = cheapest_offer(per_date, ["check_in", *ORDER_COLUMNS])
    label = place["display_name"] if place else area
    return result(cap_by_price(merged, max_results), "stays_listing", label)
