"""Search over normalised listing tables, one function per source.

Each takes the source's listing rows (with ``page`` and ``pos``) and returns the
capped rows plus a one-row summary.  Arguments are checked before any job runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions.dates import resolve_stay
from listinglake.operators import filters
from listinglake.operators.dedupe import dedupe_first, dedupe_later_pages
from listinglake.operators.offers import cheapest_offer
from listinglake.operators.summary import result_summary
from listinglake.operators.topk import cap, cap_by_price, cap_per_group
from listinglake.schemas import ORDER_COLUMNS, to_record
from listinglake.sources.dims import check_town

DATE_ORDER = "date_order"


@dataclass(frozen=True)
class SearchResult:
    rows: DataFrame
    summary: DataFrame


def result(
    rows: DataFrame, record: str, area: str, label: str = "search_area"
) -> SearchResult:
    return SearchResult(to_record(rows, record), result_summary(rows, area, label))


def in_area(listings: DataFrame, place: dict | None) -> DataFrame:
    if place is None:
        return listings
    corners = ("sw_lat", "sw_lng", "ne_lat", "ne_lng")
    return filters.filter_bbox(listings, *[place[c] for c in corners])


def stay_candidates(
    listings: DataFrame,
    place: dict | None,
    min_bedrooms: int,
    min_bathrooms: float,
    price_min: float,
    price_max: float,
) -> DataFrame:
    """One row per (date, listing), then the nightly price bounds.

    The repeat is dropped before the price test, so an over-priced first copy
    hides a later one.
    """
    rows = in_area(listings, place)
    if min_bedrooms:
        rows = filters.filter_min_bedrooms(rows, min_bedrooms)
    if min_bathrooms:
        rows = rows.filter(F.col("bathrooms") >= min_bathrooms)
    rows = dedupe_first(rows, ["check_in", "listing_id"])
    return filters.filter_nightly_price(rows, price_min, price_max)


def search_stays(
    listings: DataFrame,
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
    """Stays for one arrival date, in source order."""
    first, _, count = resolve_stay(check_in, check_out, nights)
    asked = listings.filter((F.col("check_in") == first) & (F.col("nights") == count))
    rows = stay_candidates(
        asked, place, min_bedrooms, min_bathrooms, price_min, price_max
    )
    label = place["display_name"] if place else area
    return result(cap(rows, max_results), "stays_listing", label)


def search_stays_on_dates(
    listings: DataFrame,
    *,
    check_in_dates: list[str],
    nights: int,
    check_in: str = "",
    place: dict | None = None,
    area: str = "",
    min_bedrooms: int = 0,
    min_bathrooms: float = 0,
    price_min: float = 0,
    price_max: float = 0,
    max_results: int = fv.DEFAULT_CAP,
) -> SearchResult:
    """Stays over several arrival dates, each listing at its cheapest date.

    Every date is capped on its own first; the merged rows are sorted by price and
    capped again.
    """
    if check_in:
        raise ValueError("Provide either check_in or check_in_dates, not both")
    if not check_in_dates:
        raise ValueError("Provide either check_in or check_in_dates")
    if not nights:
        raise ValueError("nights is required when using check_in_dates")
    dates = [resolve_stay(d, None, nights)[0] for d in check_in_dates]
    asked = listings.filter(
        F.col("check_in").isin(dates) & (F.col("nights") == nights)
    )
    rows = stay_candidates(
        asked, place, min_bedrooms, min_bathrooms, price_min, price_max
    )
    per_date = cap_per_group(rows, ["check_in"], max_results).withColumn(
        DATE_ORDER, F.array_position(F.array(*map(F.lit, dates)), F.col("check_in"))
    )
    merged = cheapest_offer(per_date, [DATE_ORDER, *ORDER_COLUMNS])
    label = place["display_name"] if place else area
    return result(cap_by_price(merged, max_results), "stays_listing", label)


def search_carolinadesigns(
    listings: DataFrame,
    town: str,
    min_bedrooms: int = 0,
    max_results: int = fv.DEFAULT_CAP,
    title: str | None = None,
) -> SearchResult:
    """Homes of one town; the label is the page title, else the town."""
    rows = filters.filter_town(listings, fv.CAROLINADESIGNS, town)
    rows = filters.filter_min_bedrooms(rows, min_bedrooms)
    area = (title or "").strip() or town.title()
    return result(cap(rows, max_results), "carolinadesigns_listing", area)


def search_churchrealty(
    listings: DataFrame,
    city: str = "",
    state: str = "",
    listing_type: str = "",
    max_results: int = fv.DEFAULT_CAP,
) -> SearchResult:
    rows = filters.filter_contains_ci(listings, "city", city)
    rows = filters.filter_contains_ci(rows, "state", state)
    rows = filters.filter_listing_type(rows, listing_type)
    return result(cap(rows, max_results), "churchrealty_listing", fv.CHURCHREALTY_AREA)


def search_crexi(
    listings: DataFrame,
    query: str,
    property_type: str = "",
    min_price: float = 0,
    max_price: float = 0,
    max_results: int = fv.DEFAULT_CAP,
) -> SearchResult:
    """Rows landed for ``query``; type and price are filtered here."""
    if not query:
        raise ValueError("query is required")
    rows = listings.filter(F.col("query") == query)
    rows = filters.filter_contains_ci(rows, "property_type", property_type)
    rows = filters.filter_price_range(rows, min_price, max_price)
    return result(cap(rows, max_results), "crexi_listing", query, "search_query")


def search_redfin(
    listings: DataFrame,
    zip_code: str,
    min_beds: int = 0,
    max_beds: int = 0,
    min_price: float = 0,
    max_price: float = 0,
    max_results: int = fv.DEFAULT_CAP,
) -> SearchResult:
    """Rows landed for one ZIP page."""
    rows = listings.filter(F.col("zip_code") == zip_code)
    rows = filters.filter_beds_range(rows, min_beds, max_beds)
    rows = filters.filter_price_range(rows, min_price, max_price)
    return result(cap(rows, max_results), "redfin_listing", f"ZIP {zip_code}")


def search_sunrealty(
    listings: DataFrame,
    town: str,
    min_bedrooms: int = 0,
    max_results: int = fv.DEFAULT_CAP,
) -> SearchResult:
    """Homes of one town; this source stores the display name."""
    _, display = check_town(fv.SUNREALTY, town)
    rows = listings.filter(F.col("town") == display)
    rows = filters.filter_min_bedrooms(rows, min_bedrooms)
    area = display + fv.SUNREALTY_AREA_SUFFIX
    return result(cap(rows, max_results), "sunrealty_listing", area)


def search_surforsound(
    listings: DataFrame,
    town: str,
    min_bedrooms: int = 0,
    max_results: int = fv.DEFAULT_CAP,
    check_in: str = "",
    strict: bool = False,
) -> SearchResult:
    """Homes of one village over all its pages.

    Repeats inside page 1 stay, as on the site; ``strict`` drops those too.
    """
    slug, _ = check_town(fv.SURFORSOUND, town)
    rows = listings.filter((F.col("town") == slug) & (F.col("check_in") == check_in))
    rows = dedupe_first(rows, ["listing_id"]) if strict else dedupe_later_pages(rows)
    rows = filters.filter_min_bedrooms(rows, min_bedrooms)
    area = slug.title() + fv.SURFORSOUND_AREA_SUFFIX
    return result(cap(rows, max_results), "surforsound_listing", area)


def search_twiddy(
    listings: DataFrame,
    town: str,
    min_bedrooms: int = 0,
    max_results: int = fv.DEFAULT_CAP,
) -> SearchResult:
    _, display = check_town(fv.TWIDDY, town)
    rows = filters.filter_town(listings, fv.TWIDDY, town)
    rows = filters.filter_min_bedrooms(rows, min_bedrooms)
    area = display + fv.TWIDDY_AREA_SUFFIX
    return result(cap(rows, max_results), "twiddy_listing", area)
