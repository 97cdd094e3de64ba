"""Filters, de-duplication, cheapest offers and ordering over the offers."""

from __future__ import annotations

from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.operators import dedupe, filters, topk
from listinglake.operators.offers import cheapest_offer, first_search_area
from listinglake.operators.summary import result_summary
from listinglake.operators.union import union_all, union_sources
from listinglake.plans import search
from listinglake.plans.budget import large_homes
from listinglake.workload.tables import (
    FIRST_OFFERS, OFFER_COLUMNS, OFFER_ORDER, OFFERS, offer_columns, offers, query,
)

_ALL = f"WITH {OFFERS} SELECT {OFFER_COLUMNS} FROM offers WHERE "


@query("filter_nightly_price", _ALL + "total_price >= 500 * nights AND total_price <= 2500 * nights")
def nightly_price(spark, sf):
    return offer_columns(filters.filter_nightly_price(offers(spark, sf), 500, 2500))


@query("filter_price_range", _ALL + "total_price >= 20000 AND total_price <= 60000")
def price_range(spark, sf):
    return offer_columns(
        filters.filter_price_range(offers(spark, sf), 20000, 60000, price="total_price")
    )


@query("filter_beds_range", _ALL + "bedrooms >= 3 AND bedrooms <= 7")
def beds_range(spark, sf):
    return offer_columns(filters.filter_beds_range(offers(spark, sf), 3, 7))


@query("filter_min_bedrooms", _ALL + "coalesce(bedrooms, 0) >= 7")
def min_bedrooms(spark, sf):
    return offer_columns(filters.filter_min_bedrooms(offers(spark, sf), 7))


@query("filter_min_bedrooms_unset", _ALL + "coalesce(bedrooms, 0) >= 0")
def min_bedrooms_unset(spark, sf):
    return offer_columns(filters.filter_min_bedrooms(offers(spark, sf), 0))


@query("filter_contains_ci", _ALL + "lower(name) LIKE '%blue w%'")
def contains_ci(spark, sf):
    return offer_columns(filters.filter_contains_ci(offers(spark, sf), "name", "BLUE W"))


@query(
    "filter_listing_type",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'For Sale' WHEN 'O' THEN 'For Lease' "
    "ELSE 'Unknown' END AS listing_type FROM orders WHERE o_orderstatus = 'O'",
)
def listing_type_alias(spark, sf):
    from listinglake.functions.text import listing_type
    from listinglake.workload.tables import table

    slug = F.concat(
        F.lit("hall-"),
        F.when(F.col("o_orderstatus") == "F", "for-sale")
        .when(F.col("o_orderstatus") == "O", "for-lease")
        .otherwise("other"),
        F.lit("-x"),
    )
    rows = table(spark, sf, "orders").select("o_orderkey", listing_type(slug).alias("listing_type"))
    return filters.filter_listing_type(rows, "Rent or buy")


@query("filter_town", _ALL + "town = 'nation-7'")
def town_equals(spark, sf):
    """The town stands under its display name in some rows, under its slug in others."""
    town, odd = F.col("town"), F.col("l_orderkey") % 2 == 1
    named = F.when(town == "nation-7", F.when(odd, "Duck").otherwise("duck")).otherwise(town)
    found = filters.filter_town(offers(spark, sf).withColumn("town", named), fv.TWIDDY, " DUCK ")
    return offer_columns(found.withColumn("town", F.lit("nation-7")))


@query("filter_budget", _ALL + "total_price <= 11000")
def budget(spark, sf):
    return offer_columns(filters.filter_budget(offers(spark, sf), 11000, rate="total_price"))


_AUGUSTS = [f"{y}-08-{d:02d}" for y in range(1995, 2002) for d in range(1, 32)]


@query(
    "filter_stay_rule",
    _ALL + "bedrooms >= 7 AND nights = 7 AND total_price <= 60000 "
    "AND check_in[6:7] = '08' AND check_in BETWEEN '1995' AND '2002' "
    "AND coalesce(rating, 4.0) >= 4.0",
)
def stay_rule(spark, sf):
    return offer_columns(
        filters.filter_stay_rule(offers(spark, sf), _AUGUSTS, max_total=60000)
    )


@query("drop_missing_id", _ALL + "l_suppkey % 5 <> 0 AND l_suppkey % 7 <> 0")
def drop_missing_id(spark, sf):
    blank = F.when(F.col("l_suppkey") % 5 == 0, F.lit(None)).when(
        F.col("l_suppkey") % 7 == 0, F.lit("")
    ).otherwise(F.col("listing_id"))
    return offer_columns(filters.drop_missing_id(offers(spark, sf).withColumn("listing_id", blank)))


@query("dedupe_first", f"WITH {OFFERS}, {FIRST_OFFERS} SELECT {OFFER_COLUMNS} FROM first_offers")
def dedupe_first(spark, sf):
    return offer_columns(
        dedupe.dedupe_first(offers(spark, sf), ["check_in", "listing_id"], OFFER_ORDER)
    )


@query(
    "dedupe_later_pages",
    f"""WITH {OFFERS}, seen AS (SELECT DISTINCT listing_id FROM offers WHERE page = 1),
    later AS (
      SELECT * FROM offers WHERE page > 1 AND listing_id NOT IN (SELECT listing_id FROM seen)
      QUALIFY row_number() OVER (PARTITION BY listing_id
        ORDER BY page, l_orderkey, l_suppkey, total, nights, check_in) = 1)
    SELECT {OFFER_COLUMNS} FROM offers WHERE page = 1
    UNION ALL SELECT {OFFER_COLUMNS} FROM later""",
)
def dedupe_later_pages(spark, sf):
    return offer_columns(
        dedupe.dedupe_later_pages(
            offers(spark, sf), "listing_id", [*OFFER_ORDER, "check_in"]
        )
    )


_BEST = """
best AS (
  SELECT * FROM first_offers WHERE total_price <= 2500 * nights
  QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY (total_price IS NULL), total_price,
    check_in, page, l_orderkey, l_suppkey, total, nights) = 1
)"""
DATE_ORDER = ["check_in", *OFFER_ORDER]


@query(
    "cheapest_offer",
    f"""WITH {OFFERS}, best AS (
      SELECT * FROM offers QUALIFY row_number() OVER (PARTITION BY listing_id
        ORDER BY (total_price IS NULL), total_price, check_in, page, l_orderkey, l_suppkey,
          total, nights) = 1),
    seen AS (SELECT listing_id, min(check_in) AS first_check_in FROM offers GROUP BY listing_id)
    SELECT {OFFER_COLUMNS}, first_check_in FROM best JOIN seen USING (listing_id)""",
)
def cheapest(spark, sf):
    best = cheapest_offer(offer_columns(offers(spark, sf)), DATE_ORDER)
    return best.select(
        *OFFER_COLUMNS.split(", "), F.col("first_seen.check_in").alias("first_check_in")
    )


@query(
    "cheapest_stays",
    f"WITH {OFFERS}, {FIRST_OFFERS}, {_BEST} SELECT {OFFER_COLUMNS} FROM best "
    "WHERE coalesce(bedrooms, 0) >= 2",
)
def cheapest_stays(spark, sf):
    """Flagship: first copy per date, nightly budget, cheapest date, bedrooms."""
    rows = offer_columns(offers(spark, sf))
    rows = dedupe.dedupe_first(rows, ["check_in", "listing_id"], OFFER_ORDER)
    rows = filters.filter_nightly_price(rows, high=2500)
    rows = cheapest_offer(rows, DATE_ORDER)
    return offer_columns(filters.filter_min_bedrooms(rows, 2))


@query(
    "first_search_area",
    f"""WITH {OFFERS} SELECT coalesce((SELECT CASE WHEN page % 3 = 0 THEN town END AS area
      FROM offers WHERE page % 3 = 0 ORDER BY check_in, page, l_orderkey, l_suppkey, total, nights,
      listing_id LIMIT 1), '') AS search_area""",
)
def search_area(spark, sf):
    area = F.when(F.col("page") % 3 == 0, F.col("town")).otherwise("")
    rows = offers(spark, sf).withColumn("search_area", area)
    return first_search_area(rows, [*DATE_ORDER, "listing_id"])


@query(
    "sort_nulls_last",
    f"""WITH {OFFERS}, best AS (
      SELECT * FROM offers QUALIFY row_number() OVER (PARTITION BY listing_id
        ORDER BY (total_price IS NULL), total_price, check_in, page, l_orderkey, l_suppkey,
          total, nights) = 1),
    seen AS (SELECT listing_id, min(struct_pack(a := check_in, b := page, c := l_orderkey,
      d := l_suppkey, e := total, f := nights)) AS first_seen FROM offers GROUP BY listing_id)
    SELECT listing_id, total_price, check_in FROM best JOIN seen USING (listing_id)
    ORDER BY (total_price IS NULL), total_price, first_seen""",
)
def sort_nulls_last(spark, sf):
    best = cheapest_offer(offer_columns(offers(spark, sf)), DATE_ORDER)
    return topk.sort_by_price(best).select("listing_id", "total_price", "check_in")


@query(
    "search_capped",
    f"""WITH {OFFERS} SELECT {OFFER_COLUMNS} FROM offers WHERE coalesce(bedrooms, 0) >= 7
    ORDER BY page, l_orderkey, l_suppkey, total, nights, check_in, listing_id LIMIT 50""",
)
def search_capped(spark, sf):
    rows = filters.filter_min_bedrooms(offers(spark, sf), 7)
    return offer_columns(topk.cap(rows, 50, [*OFFER_ORDER, "check_in", "listing_id"]))


@query(
    "cap_per_date",
    f"""WITH {OFFERS}, {FIRST_OFFERS} SELECT {OFFER_COLUMNS} FROM first_offers
    QUALIFY row_number() OVER (PARTITION BY check_in
      ORDER BY page, l_orderkey, l_suppkey, total, nights, listing_id) <= 5""",
)
def cap_per_date(spark, sf):
    rows = dedupe.dedupe_first(offers(spark, sf), ["check_in", "listing_id"], OFFER_ORDER)
    return offer_columns(
        topk.cap_per_group(rows, ["check_in"], 5, [*OFFER_ORDER, "listing_id"])
    )


@query(
    "cap_per_town_large",
    f"""WITH {OFFERS} SELECT {OFFER_COLUMNS} FROM offers
    QUALIFY row_number() OVER (PARTITION BY town ORDER BY total, page, l_orderkey, l_suppkey,
      nights, check_in, listing_id) <= 1500""",
)
def cap_per_town_large(spark, sf):
    """A cap above Spark's own group limit takes the salted way."""
    order = ["total", "page", "l_orderkey", "l_suppkey", "nights", "check_in", "listing_id"]
    return offer_columns(topk.cap_per_group(offers(spark, sf), ["town"], 1500, order))


def _stays_rows(spark, sf):
    """Offers as one-week stays that start on the first of their month.

    Many offers share a date this way, and a listing repeats within a date.
    """
    part = F.col("listing_id").cast("bigint")
    day = F.substring("check_in", 9, 2).cast("int")
    first = F.concat(F.substring("check_in", 1, 8), F.lit("01"))
    position = (F.col("l_orderkey") * 1000000 + part % 1000000) * 32 + day
    return (
        offers(spark, sf)
        .withColumn("pos", position)
        .withColumn("check_in", first)
        .withColumn("nights", F.lit(7))
        .drop("town")
    )


_DATES = "('1998-08-14', '1998-08-15', '1998-08-16')"
_MONTHS = ["1998-08-01", "1998-09-01", "1998-10-01"]
_ONE_STAY = """
asked AS (
  SELECT * FROM (
    SELECT * REPLACE (check_in[1:8] || '01' AS check_in, 7 AS nights),
      (l_orderkey * 1000000 + CAST(listing_id AS BIGINT) % 1000000) * 32
        + CAST(check_in[9:10] AS INTEGER) AS pos
    FROM offers)
  WHERE check_in IN {dates}
),
kept AS (
  SELECT * FROM (SELECT * FROM asked QUALIFY row_number() OVER (
    PARTITION BY check_in, listing_id ORDER BY page, pos) = 1)
  WHERE total_price <= 12000 * nights
),
dated AS (
  SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY check_in ORDER BY page, pos) <= 20
)"""


@query(
    "search_stays_one_date",
    f"""WITH {OFFERS}, {_ONE_STAY.format(dates="('1998-08-01')")}
    SELECT listing_id, name, property_type, bedrooms, check_in, check_out, nights, total_price
    FROM dated ORDER BY page, pos LIMIT 20""",
)
def stays_one_date(spark, sf):
    found = search.search_stays(
        _stays_rows(spark, sf), check_in="1998-08-01", nights=7, price_max=12000, max_results=20
    )
    return found.rows.select(
        "listing_id", "name", "property_type", "bedrooms", "check_in", "check_out", "nights",
        "total_price",
    )


@query(
    "multi_date_search",
    f"""WITH {OFFERS}, {_ONE_STAY.format(dates=tuple(_MONTHS))}, best AS (
      SELECT * FROM dated QUALIFY row_number() OVER (PARTITION BY listing_id
        ORDER BY (total_price IS NULL), total_price, check_in, page, pos) = 1),
    seen AS (SELECT listing_id, min(struct_pack(a := check_in, b := page, c := pos)) AS first_seen
      FROM dated GROUP BY listing_id)
    SELECT listing_id, name, property_type, bedrooms, check_in, check_out, nights, total_price
    FROM best JOIN seen USING (listing_id)
    ORDER BY (total_price IS NULL), total_price, first_seen LIMIT 20""",
)
def multi_date(spark, sf):
    found = search.search_stays_on_dates(
        _stays_rows(spark, sf),
        check_in_dates=_MONTHS,
        nights=7, price_max=12000, max_results=20,
    )
    return found.rows.select(
        "listing_id", "name", "property_type", "bedrooms", "check_in", "check_out", "nights",
        "total_price",
    )


@query(
    "result_summary",
    f"""WITH {OFFERS}, {_ONE_STAY.format(dates="('1998-08-01')")}
    SELECT 'Outer Banks' AS search_area, CAST(count(*) AS INTEGER) AS total_returned FROM dated""",
)
def summary(spark, sf):
    return search.search_stays(
        _stays_rows(spark, sf), check_in="1998-08-01", nights=7, price_max=12000,
        max_results=20, area="Outer Banks",
    ).summary


@query(
    "summary_of_town",
    f"""WITH {OFFERS} SELECT 'Nation 7' AS search_area, CAST(count(*) AS INTEGER) AS total_returned
    FROM offers WHERE town = 'nation-7'""",
)
def summary_of_town(spark, sf):
    return result_summary(offers(spark, sf).filter(F.col("town") == "nation-7"), "Nation 7")


@query(
    "union_towns",
    _ALL + "town IN ('nation-1', 'nation-5', 'nation-9') AND coalesce(bedrooms, 0) >= 7",
)
def union_towns(spark, sf):
    towns = ["nation-1", "nation-5", "nation-9"]
    return offer_columns(large_homes(offers(spark, sf), towns, 7, None))


@query("union_pages", f"WITH {OFFERS} SELECT {OFFER_COLUMNS} FROM offers")
def union_pages(spark, sf):
    rows = offers(spark, sf)
    return offer_columns(union_all([rows.filter("page <= 3"), rows.filter("page > 3")]))


@query("union_dates", _ALL + f"check_in IN {_DATES}")
def union_dates(spark, sf):
    days = ["1998-08-14", "1998-08-15", "1998-08-16"]
    return offer_columns(offers(spark, sf).filter(F.col("check_in").isin(days)))


@query(
    "union_sources",
    f"""WITH {OFFERS} SELECT 's' || (l_suppkey % 3) AS source, listing_id, check_in, page, total,
      CASE WHEN l_suppkey % 3 = 0 THEN nights END AS nights,
      CASE WHEN l_suppkey % 3 = 1 THEN town END AS town FROM offers""",
)
def sources(spark, sf):
    rows = offers(spark, sf)
    base = ["listing_id", "check_in", "page", "total"]
    extra = {0: ["nights"], 1: ["town"], 2: []}
    parts = {
        f"s{i}": rows.filter(F.col("l_suppkey") % 3 == i).select(*base, *cols)
        for i, cols in extra.items()
    }
    return union_sources(parts)
