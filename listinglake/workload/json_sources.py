"""Normalisers of the JSON sources over responses built from orders and parts.

Spark writes the landed bodies from the tables, the normalisers read them back;
the SQL states the expected records straight from the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.plans import search as plans
from listinglake.plans.details import find_all_details
from listinglake.plans.normalize import child_tables, detail_tables, search_tables
from listinglake.session import checkpoint_dir
from listinglake.sources.landing import read_responses
from listinglake.sources.sinks import write_json, write_silver
from listinglake.workload.tables import (
    home_list, homes_sql, joined, keyed, query, responses, table,
)

HOMES = homes_sql("orders")


def text(c: Column) -> Column:
    return c.cast("string")


def cat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def beds(i: Column) -> Column:
    return F.when(i % 11 != 0, (i % 12).cast("int"))


BEDS = "CASE WHEN id % 11 <> 0 THEN CAST(id % 12 AS INTEGER) END"
AMOUNT = "CAST(id % 9000 + 100 AS DOUBLE)"


def dollars(amount: Column) -> Column:
    return cat("$", F.format_number(amount, 0))


# ---- stays ------------------------------------------------------------------------


def _state(data: Column, broken: Column) -> Column:
    """A page whose script carries the state; a broken one lost its script."""
    return F.when(broken, cat("<html>", data, "</html>")).otherwise(
        cat(
            '<html><script>var x = {"a": "</div>"};</script>'
            '<script id="data-deferred-state-0" type="application/json">'
            '{"niobeClientData": [["k", {"data": ',
            data,
            "}]]}</script><p>end</p></html>",
        )
    )


def stays_search_responses(spark, sf):
    def result(i):
        amount = i % 9000 + 100
        lines = F.filter(
            F.array(
                F.when(beds(i) == 0, "Studio bedroom").when(
                    beds(i).isNotNull(), cat(text(beds(i)), " bedrooms")
                ),
                cat(text(i % 7), " beds"),
                F.when(i % 5 == 1, "Half-bath").when(i % 5 > 1, cat(text(i % 5), ".5 baths")),
            ),
            lambda t: t.isNotNull(),
        )
        return F.struct(
            F.struct(
                F.when(
                    i % 13 != 0,
                    F.base64(cat("DemandStayListing:", text(i)).cast("binary")),
                ).alias("id"),
                F.struct(
                    F.struct(
                        (35 + i % 100 * 0.125).alias("latitude"),
                        (-80 - i % 64 * 0.0625).alias("longitude"),
                    ).alias("coordinate")
                ).alias("location"),
            ).alias("demandStayListing"),
            F.struct(F.transform(lines, lambda t: F.struct(t.alias("body"))).alias("primaryLine")).alias(
                "structuredContent"
            ),
            F.struct(
                F.struct(
                    F.when(i % 2 == 0, dollars(amount)).alias("discountedPrice"),
                    F.when(i % 10 != 5, dollars(F.when(i % 2 == 0, amount + 50).otherwise(amount))).alias(
                        "price"
                    ),
                ).alias("primaryLine")
            ).alias("structuredDisplayPrice"),
            cat("Home in ", F.col("kind_text")).alias("title"),
            F.when(i % 7 == 0, "").otherwise(F.col("label")).alias("subtitle"),
            cat("Stay ", text(i)).alias("nameLocalized"),
            F.when(
                i % 6 != 0, cat(text(3 + i % 8 * 0.25), " (", F.format_number(i % 3000, 0), ")")
            ).alias("avgRatingLocalized"),
            F.when(i % 4 != 0, F.array(F.struct(cat("https://img/", text(i)).alias("picture")))).alias(
                "contextualPictures"
            ),
        )

    data = cat(
        '{"presentation": {"staysSearch": {"results": {"searchResults": ',
        F.to_json(home_list(result)),
        ', "paginationInfo": {"pageCursors": ["a"]}}}}}',
    )
    key = F.col("key")
    return responses(
        keyed(spark, sf, "orders"), fv.STAYS, "search", _state(data, key % 17 == 0),
        check_in=F.date_add(F.lit("2026-01-03"), ((key % 20) * 7).cast("int")),
        nights=key % 7 + 1,
        page=key,
    )


_STAYS = f"""
stays AS (
  SELECT CAST(id AS VARCHAR) AS listing_id, 'https://www.airbnb.com/rooms/' || id AS url,
    CASE WHEN id % 7 = 0 THEN 'Stay ' || id ELSE label END AS name,
    'Home in ' || kind_text AS property_type, {BEDS} AS bedrooms,
    CAST(id % 7 AS INTEGER) AS beds,
    CASE WHEN id % 5 = 1 THEN CAST(0.5 AS DOUBLE) WHEN id % 5 > 1
      THEN id % 5 + CAST(0.5 AS DOUBLE) END AS bathrooms,
    35 + (id % 100) * CAST(0.125 AS DOUBLE) AS latitude,
    -80 - (id % 64) * CAST(0.0625 AS DOUBLE) AS longitude,
    CASE WHEN id % 6 <> 0 THEN 3 + (id % 8) * CAST(0.25 AS DOUBLE) END AS rating,
    CASE WHEN id % 6 <> 0 THEN CAST(id % 3000 AS INTEGER) END AS review_count,
    strftime(DATE '2026-01-03' + CAST((k % 20) * 7 AS INTEGER), '%Y-%m-%d') AS check_in,
    strftime(DATE '2026-01-03' + CAST((k % 20) * 7 + k % 7 + 1 AS INTEGER), '%Y-%m-%d') AS check_out,
    CAST(k % 7 + 1 AS INTEGER) AS nights,
    CASE WHEN id % 10 <> 5 THEN {AMOUNT} END AS total_price,
    CASE WHEN id % 10 <> 5 THEN '$' END AS price_currency,
    CASE WHEN id % 10 <> 5 THEN '$' || format('{{:,}}', id % 9000 + 100) END AS price_display,
    CASE WHEN id % 4 <> 0 THEN 'https://img/' || id END AS image_url,
    CAST(k AS INTEGER) AS page, pos
  FROM homes WHERE id % 13 <> 0 AND k % 17 <> 0
)"""


@query("normalize_stays_search", f"WITH {HOMES}, {_STAYS} SELECT * FROM stays")
def normalize_stays_search(spark, sf):
    return search_tables(stays_search_responses(spark, sf), fv.STAYS).rows


@query(
    "quarantine_stays_search",
    """SELECT 'stays' AS source, 'search' AS kind, CAST(o_orderkey AS INTEGER) AS page,
      'page has no embedded state' AS drift FROM orders WHERE o_orderkey % 17 = 0""",
)
def quarantine_stays(spark, sf):
    return search_tables(stays_search_responses(spark, sf), fv.STAYS).quarantine.select(
        "source", "kind", "page", "drift"
    )


@query(
    "search_stays",
    f"""WITH {HOMES}, {_STAYS} SELECT * EXCLUDE (page, pos) FROM stays
    WHERE check_in = '2026-01-31' AND nights = 5 AND latitude BETWEEN 36 AND 44
      AND longitude BETWEEN -83.5 AND -80 AND coalesce(bedrooms, 0) >= 2
      AND total_price >= 100 * 5 AND total_price <= 1500 * 5
    ORDER BY page, pos LIMIT 50""",
)
def search_stays(spark, sf):
    place = {
        "sw_lat": 36.0, "sw_lng": -83.5, "ne_lat": 44.0, "ne_lng": -80.0, "display_name": "Banks",
    }
    rows = search_tables(stays_search_responses(spark, sf), fv.STAYS).rows
    return plans.search_stays(
        rows, check_in="2026-01-31", nights=5, place=place, min_bedrooms=2, price_min=100,
        price_max=1500,
    ).rows


def stays_detail_responses(spark, sf):
    key, label = F.col("key"), F.col("label")

    def section(name, body):
        return cat(f'{{"sectionId": "{name}", "section": ', F.to_json(F.struct(*body)), "}")

    def amenity(title, available):
        return F.struct(title.alias("title"), available.alias("available"))

    groups = F.array(
        F.struct(F.array(amenity(cat("Wifi ", text(key % 5)), F.lit(True)),
                         amenity(F.lit("TV"), key % 2 == 0)).alias("amenities")),
        F.struct(F.array(amenity(F.lit(""), F.lit(True)), amenity(label, key % 3 == 0)).alias("amenities")),
    )
    stats = F.array(
        F.struct(F.lit("REVIEW_COUNT").alias("type"), F.format_number(key, 0).alias("value")),
        F.struct(F.lit("REVIEW_COUNT").alias("type"), F.lit("n/a").alias("value")),
    )
    ratings = F.array(
        F.struct(F.lit("Value").alias("label"), F.lit("1.0").alias("localizedRating")),
        F.struct(F.lit("Value").alias("label"), text(key % 5).alias("localizedRating")),
    )
    beds_ = F.array(F.struct(cat("Bedroom ", text(key % 4)).alias("title"), label.alias("subtitle")))
    photos = F.array(F.struct(cat("https://i/", text(key)).alias("baseUrl")), F.struct(F.lit("https://i/a").alias("baseUrl")))
    sections = [
        section("TITLE_DEFAULT", [F.lit("old").alias("title")]),
        section("TITLE_DEFAULT", [cat("House ", text(key)).alias("title")]),
        section("DESCRIPTION_DEFAULT", [F.struct(cat("<p>", label, "</p>&nbsp;<b>x</b>").alias("htmlText")).alias("htmlDescription")]),
        section("AMENITIES_DEFAULT", [groups.alias("seeAllAmenitiesGroups")]),
        section("MEET_YOUR_HOST", [
            F.struct(label.alias("name"), (key % 2 == 0).alias("isSuperhost"), stats.alias("stats")).alias("cardData"),
            F.col("kind_text").alias("about")]),
        section("REVIEWS_DEFAULT", [(key % 5 + 0.5).alias("overallRating"), (key % 900).alias("overallCount"), ratings.alias("ratings")]),
        section("LOCATION_DEFAULT", [label.alias("subtitle"), (key % 90 * 0.5).alias("lat"), (-(key % 90) * 0.5).alias("lng")]),
        section("POLICIES_DEFAULT", [F.array(F.struct(F.lit("No smoking").alias("title")), F.struct(label.alias("title"))).alias("houseRules"),
                                     F.col("kind_text").alias("cancellationPolicyForDisplay")]),
        section("BOOK_IT_SIDEBAR", [(key % 16).alias("maxGuestCapacity")]),
        section("SLEEPING_ARRANGEMENT_WITH_IMAGES", [beds_.alias("arrangementDetails")]),
        section("HIGHLIGHTS_DEFAULT", [F.array(F.struct(label.alias("title"), F.lit("s").alias("subtitle"))).alias("highlights")]),
        section("HERO_DEFAULT", [photos.alias("previewImages")]),
    ]
    tour = F.to_json(F.array(F.struct(F.array(
        F.struct(F.struct(F.lit("https://i/a").alias("uri")).alias("image")),
        F.struct(F.struct(cat("https://i/b", text(key)).alias("uri")).alias("image"))).alias("items"))))
    data = cat(
        '{"presentation": {"stayProductDetailPage": {"sections": {"sections": [',
        F.concat_ws(", ", *sections),
        ']}}}, "node": {"pdpPresentation": {"mediaTour": {"stops": ', tour, "}}}}",
    )
    return responses(
        keyed(spark, sf, "orders"), fv.STAYS, "details", _state(data, F.lit(False)),
        entity_id=cat("https://h/rooms/", text(key), "?x=1"),
    )


@query(
    "normalize_stays_details",
    """SELECT CAST(k AS VARCHAR) AS listing_id, 'https://www.airbnb.com/rooms/' || k AS url,
      'House ' || k AS title, label || '   x' AS description, CAST(k % 16 AS INTEGER) AS max_guests,
      'Bedroom ' || (k % 4) || ': ' || label AS sleeping_arrangements, label AS location_subtitle,
      (k % 90) * CAST(0.5 AS DOUBLE) AS latitude, 0 - (k % 90) * CAST(0.5 AS DOUBLE) AS longitude,
      label AS host_name, k % 2 = 0 AS host_is_superhost, false AS host_is_verified,
      kind AS host_about, CAST(k AS INTEGER) AS host_review_count,
      k % 5 + CAST(0.5 AS DOUBLE) AS overall_rating, CAST(k % 900 AS INTEGER) AS review_count,
      CAST(k % 5 AS VARCHAR) AS value_rating, false AS is_guest_favorite,
      concat_ws('|', 'Wifi ' || (k % 5), CASE WHEN k % 2 = 0 THEN 'TV' END,
        CASE WHEN k % 3 = 0 THEN label END) AS amenities,
      concat_ws('|', CASE WHEN k % 2 <> 0 THEN 'TV' END, CASE WHEN k % 3 <> 0 THEN label END)
        AS unavailable_amenities,
      label || '/s' AS highlights, 'No smoking|' || label AS house_rules,
      kind AS cancellation_policy,
      'https://i/' || k || '|https://i/a|https://i/b' || k AS image_urls
    FROM (SELECT o_orderkey AS k, o_orderpriority AS label, o_orderstatus AS kind FROM orders)""",
)
def normalize_stays_details(spark, sf):
    rows = detail_tables(stays_detail_responses(spark, sf), fv.STAYS).rows
    lists = [
        "sleeping_arrangements", "amenities", "unavailable_amenities", "house_rules", "image_urls",
    ]
    pairs = F.transform("highlights", lambda h: cat(h["title"], "/", h["subtitle"]))
    plain = [c for c in rows.columns if c not in (*lists, "highlights", "rating_breakdown", "page", "pos")]
    return rows.select(
        *plain,
        *joined(*lists),
        F.array_join(pairs, "|").alias("highlights"),
        F.col("rating_breakdown")["Value"].alias("value_rating"),
    ).withColumn("longitude", 0 - (-F.col("longitude")))


# ---- carolinadesigns ----------------------------------------------------------------

# Town slugs in the order of the fixed list.
_CD_TOWNS = [s for src, s, _, _ in fv.TOWNS if src == fv.CAROLINADESIGNS]


def _pick(values: list[str], n: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), n.cast("int"))


def _pick_sql(values: list[str], n: str) -> str:
    return f"([{', '.join(repr(v) for v in values)}])[CAST({n} AS INTEGER) + 1]"


def carolinadesigns_search_responses(spark, sf):
    def result(i):
        return F.struct(
            F.when(i % 13 != 0, cat(" ", text(i), " ")).otherwise(" ").alias("Propid"),
            F.col("label").alias("Propname"),
            beds(i).alias("Bedrooms"),
            F.when(i % 6 != 0, cat(text(i % 9), "/", text(i % 3))).alias("Baths"),
            F.when(i % 4 == 0, cat("/p/", text(i))).when(i % 4 == 1, cat("https://x/", text(i))).otherwise("").alias("PropURL"),
            F.col("kind_text").alias("DisplayLocation"),
            F.when(i % 5 != 0, F.col("label")).alias("DisplaySub"),
            cat("https://img/", text(i)).alias("ImageURL"),
            F.when(i % 3 != 0, i % 3 == 1).alias("PetFriendly"),
            (i % 2 == 0).alias("PrivatePool"),
        )

    key = F.col("key")
    body = F.when(key % 19 == 0, '{"Title": "Gone"}').otherwise(
        cat('{"Title": " Outer ", "Results": ', F.to_json(home_list(result)), "}")
    )
    return responses(
        keyed(spark, sf, "orders"), fv.CAROLINADESIGNS, "search", body,
        params={"town": _pick(_CD_TOWNS, key % 6)}, page=key,
    )


_CD = f"""
cd AS (
  SELECT CAST(id AS VARCHAR) AS listing_id,
    CASE id % 4 WHEN 0 THEN 'https://www.carolinadesigns.com/p/' || id WHEN 1 THEN 'https://x/' || id
      ELSE 'https://www.carolinadesigns.com/property-detail-page/' || id END AS url,
    label AS name, {BEDS} AS bedrooms,
    CASE WHEN id % 6 <> 0 THEN CAST(id % 9 AS INTEGER) END AS bathrooms_full,
    CASE WHEN id % 6 <> 0 THEN CAST(id % 3 AS INTEGER) END AS bathrooms_half,
    {_pick_sql(_CD_TOWNS, "k % 6")} AS town, kind_text AS location,
    CASE WHEN id % 5 <> 0 THEN label END AS subdivision, 'https://img/' || id AS image_url,
    id % 3 = 1 AS pet_friendly, id % 2 = 0 AS private_pool, CAST(k AS INTEGER) AS page, pos
  FROM homes WHERE id % 13 <> 0 AND k % 19 <> 0
)"""


@query("normalize_carolinadesigns_search", f"WITH {HOMES}, {_CD} SELECT * FROM cd")
def normalize_carolinadesigns_search(spark, sf):
    return search_tables(carolinadesigns_search_responses(spark, sf), fv.CAROLINADESIGNS).rows


@query(
    "search_carolinadesigns",
    f"""WITH {HOMES}, {_CD} SELECT * EXCLUDE (page, pos) FROM cd
    WHERE town = 'duck' AND coalesce(bedrooms, 0) >= 7 ORDER BY page, pos LIMIT 100""",
)
def search_carolinadesigns(spark, sf):
    rows = search_tables(carolinadesigns_search_responses(spark, sf), fv.CAROLINADESIGNS).rows
    return plans.search_carolinadesigns(rows, " Duck", 7, 100).rows


def carolinadesigns_detail_responses(spark, sf):
    key, label = F.col("key"), F.col("label")

    def week(n):
        taken = (key + n) % 4 == 0
        return F.struct(
            F.date_format(F.date_add(F.lit("2026-05-02"), n * 7), "M/d/yyyy").alias("ArrivalDate"),
            F.when(taken, "$0.00").otherwise(
                cat("$", F.format_number((key % 9000 + 100 + n).cast("double"), 2))
            ).alias("Rate"),
            F.when(taken, "Booked").otherwise("$670.00").alias("CostPerNight"),
            F.when(taken, "").otherwise("NORM").alias("BookType"),
        )

    weeks = F.transform(F.sequence(F.lit(0), (key % 4).cast("int")), week)
    body = F.to_json(
        F.struct(
            text(key).alias("Propid"), label.alias("Propname"),
            F.lit("Kill Devil Hills").alias("Area"),
            F.when(key % 5 != 0, text(key % 20)).alias("NumBedrooms"),
            F.array(cat("Full Bathrooms: ", text(key % 9)), F.lit("x"), cat("Half Bathrooms ", text(key % 3))).alias("Bathroominfo"),
            cat(text(key % 30), "+").alias("Sleeps"),
            cat("<p>", label, "</p><b>b</b>").alias("Description"),
            F.array(F.struct(F.array(F.lit("Pool"), F.lit("")).alias("Items")), F.struct(F.array(label).alias("Items"))).alias("Sidebar"),
            F.array(F.struct(cat("https://i/", text(key)).alias("ImgUrl")), F.struct(F.lit("").alias("ImgUrl"))).alias("PicsLarge"),
            weeks.alias("Weeks1CurrAvail"),
            (key % 5000).cast("int").alias("MinPrice"),
            F.when(key % 2 == 0, cat("https://c/", text(key))).alias("CanonicalUrl"),
        )
    )
    return responses(
        keyed(spark, sf, "orders"), fv.CAROLINADESIGNS, "details", body, entity_id=text(key)
    )


def _carolinadesigns_details(spark, sf):
    return detail_tables(carolinadesigns_detail_responses(spark, sf), fv.CAROLINADESIGNS).rows


@query(
    "normalize_carolinadesigns_details",
    """SELECT CAST(k AS VARCHAR) AS listing_id, CASE WHEN k % 2 = 0 THEN 'https://c/' || k
        ELSE 'https://www.carolinadesigns.com/property-detail-page/' || k END AS url,
      label AS name, 'kill-devil-hills' AS town,
      CASE WHEN k % 5 <> 0 THEN CAST(k % 20 AS INTEGER) END AS bedrooms,
      CAST(k % 9 AS INTEGER) AS bathrooms_full, CAST(k % 3 AS INTEGER) AS bathrooms_half,
      CAST(k % 30 AS INTEGER) AS sleeps, label || '  b' AS description, 'Pool|' || label AS amenities,
      'https://i/' || k AS image_urls, CAST(k % 5000 AS INTEGER) AS min_price,
      CAST(NULL AS INTEGER) AS max_price
    FROM (SELECT o_orderkey AS k, o_orderpriority AS label FROM orders)""",
)
def normalize_carolinadesigns_details(spark, sf):
    rows = _carolinadesigns_details(spark, sf)
    plain = [c for c in rows.columns if c not in ("amenities", "image_urls", "weekly_rates", "page", "pos")]
    return rows.select(*plain, *joined("amenities", "image_urls"))


@query(
    "weekly_rates_display",
    """SELECT CAST(k AS VARCHAR) AS listing_id, CAST(n AS INTEGER) AS pos,
      strftime(DATE '2026-05-02' + CAST(n * 7 AS INTEGER), '%-m/%-d/%Y') AS arrival_date,
      CASE WHEN (k + n) % 4 <> 0 THEN '$' || format('{:,}', k % 9000 + 100 + n) || '.00' END
        AS weekly_rate,
      CASE WHEN (k + n) % 4 <> 0 THEN '$670.00' ELSE 'Booked' END AS nightly_rate,
      CASE WHEN (k + n) % 4 <> 0 THEN 'NORM' END AS book_type
    FROM (SELECT o_orderkey AS k FROM orders), (SELECT unnest(range(4)) AS n) WHERE n <= k % 4""",
)
def weekly_rates_display(spark, sf):
    details = _carolinadesigns_details(spark, sf)
    return child_tables(details, fv.CAROLINADESIGNS)["weekly_rates"]


# ---- crexi ------------------------------------------------------------------------------


def crexi_search_responses(spark, sf):
    def result(i):
        place = F.struct(
            cat(text(i), " Main").alias("address"), F.col("label").alias("city"),
            F.struct(F.col("kind_text").alias("code")).alias("state"), text(i % 90000).alias("zip"),
        )
        return F.struct(
            i.alias("id"), F.when(i % 8 != 0, F.col("label")).alias("name"),
            cat("https://t/", text(i)).alias("thumbnailUrl"),
            F.when(i % 3 != 0, cat("slug-", text(i))).alias("urlSlug"),
            F.when(i % 4 != 0, (i % 9000 + 100).cast("double")).alias("askingPrice"),
            F.when(i % 5 != 0, (i % 7000).cast("int")).alias("squareFootage"),
            F.when(i % 6 != 0, F.array(F.lit("Retail"), F.col("kind_text"))).alias("types"),
            F.when(i % 7 != 0, F.array(place, place)).otherwise(F.array().cast(
                "array<struct<address: string, city: string, state: struct<code: string>, zip: string>>"
            )).alias("locations"),
        )

    key = F.col("key")
    body = F.when(key % 23 == 0, '{"totalCount": 0}').otherwise(
        cat('{"data": ', F.to_json(home_list(result)), ', "totalCount": 3}')
    )
    asked = {"query": F.when(key % 2 == 0, "church").otherwise("depot")}
    return responses(keyed(spark, sf, "orders"), fv.CREXI, "search", body, params=asked, page=key)


_CREXI = f"""
crexi AS (
  SELECT CAST(id AS VARCHAR) AS listing_id,
    CASE WHEN id % 3 <> 0 THEN 'https://www.crexi.com/properties/slug-' || id || '/' || id ELSE '' END AS url,
    CASE WHEN id % 8 <> 0 THEN label ELSE '' END AS name,
    CASE WHEN id % 7 <> 0 THEN id || ' Main' ELSE '' END AS address,
    CASE WHEN id % 7 <> 0 THEN label ELSE '' END AS city,
    CASE WHEN id % 7 <> 0 THEN kind_text ELSE '' END AS state,
    CASE WHEN id % 7 <> 0 THEN CAST(id % 90000 AS VARCHAR) ELSE '' END AS zip,
    CASE WHEN id % 4 <> 0 THEN {AMOUNT} END AS price,
    CASE WHEN id % 6 <> 0 THEN 'Retail, ' || kind_text ELSE '' END AS property_type,
    CASE WHEN id % 5 <> 0 THEN CAST(id % 7000 AS INTEGER) END AS building_sqft,
    'https://t/' || id AS image_url, CAST(k AS INTEGER) AS page, pos,
    CASE WHEN k % 2 = 0 THEN 'church' ELSE 'depot' END AS query
  FROM homes WHERE k % 23 <> 0
)"""


def refetched(landed, body):
    """Every response landed twice more: an older one with ``body``, and a newer failure."""
    at = F.lit("2024-05-01").cast("timestamp")
    # A body is built once, and then landed by its fetches.
    fetches = landed.withColumn("_day", F.explode(F.array(*map(F.lit, range(3)))))
    day = F.col("_day")
    return fetches.withColumns(
        {
            "fetched_at": at + F.make_dt_interval(day),
            "http_status": F.when(day == 2, 503).otherwise(F.col("http_status")),
            "body": F.when(day == 0, body).otherwise(F.col("body")),
        }
    ).drop("_day")


@query("normalize_crexi_refetched", f"WITH {HOMES}, {_CREXI} SELECT * FROM crexi")
def normalize_crexi_refetched(spark, sf):
    landed = crexi_search_responses(spark, sf)
    return search_tables(refetched(landed, '{"data": [{"id": "old"}]}'), fv.CREXI).rows


@query("normalize_crexi_search", f"WITH {HOMES}, {_CREXI} SELECT * FROM crexi")
def normalize_crexi_search(spark, sf):
    return search_tables(crexi_search_responses(spark, sf), fv.CREXI).rows


@query(
    "search_crexi",
    f"""WITH {HOMES}, {_CREXI} SELECT * EXCLUDE (page, pos, query) FROM crexi
    WHERE query = 'church' AND lower(property_type) LIKE '%retail, f%' AND price >= 500 AND price <= 5000
    ORDER BY page, pos LIMIT 50""",
)
def search_crexi(spark, sf):
    rows = search_tables(crexi_search_responses(spark, sf), fv.CREXI).rows
    return plans.search_crexi(rows, "church", "Retail, F", 500, 5000).rows


def crexi_detail_responses(spark, sf):
    """Assets with gallery and broker lists; some lists are missing or refused."""
    rows = keyed(spark, sf, "orders")
    key, label = F.col("key"), F.col("label")
    asset = F.to_json(
        F.struct(
            cat("slug-", text(key)).alias("urlSlug"), label.alias("name"),
            F.when(key % 2 == 0, cat("<p>", label, "</p>")).otherwise("").alias("marketingDescription"),
            cat("plain ", text(key)).alias("description"),
            F.array(F.col("kind_text")).alias("types"), F.col("money").alias("askingPrice"),
            F.create_map(
                F.lit("Lot Size (Acres)"), F.when(key % 3 == 0, "N/A").otherwise(F.format_number(key, 0)),
                F.lit("Year Built"), F.when(key % 5 == 0, "").otherwise("1955"),
                F.lit("Year Renovated"), F.lit("1990"),
                F.lit("Square Footage"), F.format_number(key % 90000, 0),
            ).alias("details"),
            F.array(F.struct(F.lit("SquareFootage").alias("key"),
                             F.when(key % 4 == 0, "bad").otherwise(text(key % 5000)).alias("value"))).alias("summaryDetails"),
            F.array(F.struct(label.alias("city"), F.lit("TX").alias("state"))).alias("locations"),
        )
    )
    gallery = F.to_json(F.array(F.struct(cat("https://g/", text(key)).alias("imageUrl")), F.struct(F.lit("").alias("imageUrl")), F.struct(F.lit("https://g/z").alias("imageUrl"))))
    brokers = F.to_json(F.array(F.struct(label.alias("firstName"), F.lit("Lee").alias("lastName")), F.struct(F.lit("").alias("firstName"), F.lit("").alias("lastName")), F.struct(F.lit("").alias("firstName"), F.col("kind_text").alias("lastName"))))
    asked = text(key)
    return (
        responses(rows, fv.CREXI, "details", F.when(key % 29 == 0, "[]").otherwise(asset), entity_id=asked)
        .unionByName(responses(
            rows.filter(key % 6 != 1), fv.CREXI, "gallery", gallery, entity_id=asked,
            http_status=F.when(key % 6 == 2, 404).when(key % 6 == 3, 500).otherwise(200)))
        .unionByName(responses(
            rows, fv.CREXI, "brokers", F.when(key % 7 == 1, '{"a": 1}').otherwise(brokers), entity_id=asked,
            http_status=F.when(key % 7 == 2, 401).when(key % 7 == 3, 403).otherwise(200)))
    )


@query(
    "normalize_crexi_details",
    """SELECT CAST(k AS VARCHAR) AS listing_id,
      'https://www.crexi.com/properties/slug-' || k || '/' || k AS url, label AS name, '' AS address,
      label AS city, 'TX' AS state, '' AS zip, money AS price, kind AS property_type,
      CASE WHEN k % 2 = 0 THEN label ELSE 'plain ' || k END AS description,
      CAST(CASE WHEN k % 4 = 0 THEN k % 90000 ELSE k % 5000 END AS INTEGER) AS building_sqft,
      CASE WHEN k % 3 <> 0 THEN CAST(k AS DOUBLE) END AS lot_acres,
      CASE WHEN k % 5 = 0 THEN '1990' ELSE '1955' END AS year_built,
      CASE WHEN k % 6 IN (1, 2, 3) THEN '' ELSE 'https://g/' || k || '|https://g/z' END AS image_urls,
      CASE WHEN k % 7 IN (1, 2, 3) THEN '' ELSE label || ' Lee|' || kind END AS broker_names
    FROM (SELECT o_orderkey AS k, o_orderpriority AS label, o_totalprice AS money,
      o_orderstatus AS kind FROM orders) WHERE k % 29 <> 0""",
)
def normalize_crexi_details(spark, sf):
    rows = detail_tables(crexi_detail_responses(spark, sf), fv.CREXI).rows
    plain = [c for c in rows.columns if c not in ("image_urls", "broker_names", "page", "pos")]
    return rows.select(*plain, *joined("image_urls", "broker_names"))


# ---- redfin ------------------------------------------------------------------------------


def _cache_page(entries: dict[str, Column], tail: Column | str = "") -> Column:
    """A page whose script assigns the response cache; entries are JSON texts."""
    parts = []
    for name, payload in entries.items():
        wrapped = F.struct(F.struct(cat("{}&&", payload).alias("text")).alias("res"), F.lit(True).alias("loaded"))
        parts.append(cat(f'"{name}": ', F.to_json(wrapped)))
    return cat(
        "<html><script>", fv.REDFIN_STATE_MARKER,
        '{"ReactServerAgent.cache": {"dataCache": {"/other": null, ', F.concat_ws(", ", *parts),
        "}}};\nroot.Config = {};</script>", tail, "</html>",
    )


def redfin_search_responses(spark, sf):
    def value(c):
        return F.struct(c.alias("value"))

    def home(i):
        return F.struct(
            F.when(i % 13 != 0, i).alias("propertyId"),
            F.when(i % 26 != 0, i + 7).alias("listingId"),
            value(text(i + 1000)).alias("mlsId"), F.when(i % 4 != 0, i % 200).alias("dataSourceId"),
            F.lit("webp").alias("photoFormat"), beds(i).alias("beds"), (i % 9 * 0.5).alias("baths"),
            F.when(i % 10 != 5, value((i % 9000 + 100).cast("double"))).alias("price"),
            value((i % 7000).cast("int")).alias("sqFt"), value(F.when(i % 3 != 0, i % 20000)).alias("lotSize"),
            value((1900 + i % 120).cast("int")).alias("yearBuilt"),
            F.col("label").alias("city"), F.col("kind_text").alias("state"), text(i % 90000).alias("zip"),
            F.when(i % 5 == 0, cat("/NC/x/home/", text(i + 5))).when(i % 5 == 1, "/NC/x").alias("url"),
            value(cat(text(i), " {Main} St")).alias("streetLine"),
            value(F.when(i % 2 == 0, "#4").otherwise("")).alias("unitNumber"),
        )

    key = F.col("key")
    payload = cat('{"payload": {"homes": ', F.to_json(home_list(home)), "}}")
    good = _cache_page({"/z" + fv.REDFIN_SEARCH_KEY + "al=1": payload})
    body = F.when(key % 31 == 0, F.substring(good, 1, 200)).otherwise(good)
    asked = {"zip_code": F.when(key % 3 == 0, "28704").otherwise("90210")}
    return responses(keyed(spark, sf, "orders"), fv.REDFIN, "search", body, params=asked, page=key)


_REDFIN = f"""
redfin AS (
  SELECT CAST(CASE WHEN id % 5 = 0 THEN id + 5 WHEN id % 13 <> 0 THEN id ELSE id + 7 END AS VARCHAR)
      AS listing_id,
    CASE id % 5 WHEN 0 THEN 'https://www.redfin.com/NC/x/home/' || (id + 5)
      WHEN 1 THEN 'https://www.redfin.com/NC/x' ELSE '' END AS url,
    id || ' {{Main}} St' || CASE WHEN id % 2 = 0 THEN ' #4' ELSE '' END AS address, label AS city,
    kind_text AS state, CAST(id % 90000 AS VARCHAR) AS zip,
    CASE WHEN id % 10 <> 5 THEN {AMOUNT} END AS price, {BEDS} AS bedrooms,
    (id % 9) * CAST(0.5 AS DOUBLE) AS bathrooms, CAST(id % 7000 AS INTEGER) AS building_sqft,
    CASE WHEN id % 3 <> 0 THEN CAST(id % 20000 AS INTEGER) END AS lot_sqft,
    CAST(1900 + id % 120 AS INTEGER) AS year_built,
    CASE WHEN id % 4 <> 0 THEN 'https://ssl.cdn-redfin.com/photo/' || (id % 200) || '/bigphoto/'
      || right(CAST(id + 1000 AS VARCHAR), 3) || '/' || (id + 1000) || '_0.webp' END AS image_url,
    CAST(k AS INTEGER) AS page, pos, CASE WHEN k % 3 = 0 THEN '28704' ELSE '90210' END AS zip_code
  FROM homes WHERE k % 31 <> 0 AND (id % 26 <> 0 OR id % 5 = 0)
)"""


def _folder(spark, name):
    return f"{checkpoint_dir(spark)}/listinglake/{name}-{uuid.uuid4().hex}"


@query("landing_round_trip", f"WITH {HOMES}, {_CREXI} SELECT * FROM crexi")
def landing_round_trip(spark, sf):
    """Responses of two sources landed by source and kind; one is read back."""
    path = _folder(spark, "landing")
    landed = crexi_search_responses(spark, sf).unionByName(redfin_search_responses(spark, sf))
    landed.write.partitionBy("source", "kind").parquet(path)
    return search_tables(read_responses(spark, path, fv.CREXI, "search"), fv.CREXI).rows


@query("json_round_trip", f"WITH {HOMES}, {_CREXI} SELECT * FROM crexi")
def json_round_trip(spark, sf):
    path, rows = _folder(spark, "json"), search_tables(crexi_search_responses(spark, sf), fv.CREXI).rows
    write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query("silver_round_trip", f"WITH {HOMES}, {_CREXI} SELECT * FROM crexi")
def silver_round_trip(spark, sf):
    """Rows of two sources written by source; the filter prunes to one folder."""
    path = _folder(spark, "silver")
    rows = search_tables(crexi_search_responses(spark, sf), fv.CREXI).rows
    write_silver(rows, path, fv.CREXI)
    homes = search_tables(redfin_search_responses(spark, sf), fv.REDFIN).rows
    write_silver(homes, path, fv.REDFIN)
    # The folders differ in their columns, so the schema is given, not taken from a file.
    silver = spark.read.schema(rows.drop("source").schema.add("source", "string")).parquet(path)
    return silver.filter(F.col("source") == fv.CREXI).drop("source")


@query(
    "search_label",
    f"""WITH {HOMES}, {_CREXI} SELECT 'church' AS search_query,
      CAST(least(50, count(*)) AS INTEGER) AS total_returned FROM crexi
    WHERE query = 'church' AND lower(property_type) LIKE '%retail, f%' AND price >= 500
      AND price <= 5000""",
)
def search_label(spark, sf):
    rows = search_tables(crexi_search_responses(spark, sf), fv.CREXI).rows
    return plans.search_crexi(rows, "church", "Retail, F", 500, 5000).summary


@query("normalize_redfin_refetched", f"WITH {HOMES}, {_REDFIN} SELECT * FROM redfin")
def normalize_redfin_refetched(spark, sf):
    return search_tables(refetched(redfin_search_responses(spark, sf), "old"), fv.REDFIN).rows


@query("normalize_redfin_search", f"WITH {HOMES}, {_REDFIN} SELECT * FROM redfin")
def normalize_redfin_search(spark, sf):
    return search_tables(redfin_search_responses(spark, sf), fv.REDFIN).rows


@query(
    "search_redfin",
    f"""WITH {HOMES}, {_REDFIN} SELECT * EXCLUDE (page, pos, zip_code) FROM redfin
    WHERE zip_code = '28704' AND bedrooms >= 3 AND bedrooms <= 6 AND price >= 500 AND price <= 5000
    ORDER BY page, pos LIMIT 60""",
)
def search_redfin(spark, sf):
    rows = search_tables(redfin_search_responses(spark, sf), fv.REDFIN).rows
    return plans.search_redfin(rows, "28704", 3, 6, 500, 5000, 60).rows


def redfin_detail_responses(spark, sf):
    key, label = F.col("key"), F.col("label")
    info = F.struct(
        (key % 8).cast("int").alias("beds"), (key % 5 * 0.5).alias("baths"),
        F.struct(F.col("money").alias("amount")).alias("priceInfo"),
        F.struct((key % 4000).cast("int").alias("value")).alias("sqFt"),
        F.when(key % 3 != 0, key % 9000).alias("lotSize"), F.lit(2005).alias("yearBuilt"),
        F.struct(cat(text(key), " Oak").alias("assembledAddress")).alias("streetAddress"),
        label.alias("city"), F.col("kind_text").alias("state"), F.lit("28704").alias("zip"),
        (key % 4).cast("int").alias("cumulativeDaysOnMarket"),
    )

    def photo(full, small):
        return F.struct(F.struct(full.alias("fullScreenPhotoUrl"), small.alias("nonFullScreenPhotoUrl")).alias("photoUrls"))

    link = cat("https://f/", text(key))
    photos = F.array(photo(link, F.lit("s")), photo(F.lit(""), F.lit("https://s/1")), photo(link, F.lit("t")))
    home = F.to_json(F.struct(F.struct(info.alias("addressSectionInfo"), F.struct(photos.alias("photos")).alias("mediaBrowserInfo")).alias("payload")))
    agent = F.array(F.struct(F.struct(label.alias("agentName")).alias("agentInfo"), F.when(key % 2 == 0, "B & Co").otherwise("").alias("brokerName")))
    agents = F.to_json(F.struct(F.struct(F.struct(agent.alias("listingAgents")).alias("mainHouseInfo")).alias("payload")))
    block = F.to_json(F.struct(F.lit("Product").alias("@type"), cat(" ", label, " &amp; more ").alias("description")))
    ld = cat('<script type="application/ld+json">{"@type": "Thing"}</script><script type="application/ld+json">', block, "</script>")
    body = _cache_page({"/a" + fv.REDFIN_HOME_KEY: home, "/a" + fv.REDFIN_AGENT_KEY: agents}, F.when(key % 7 != 0, ld).otherwise(""))
    asked = F.when(key % 2 == 0, text(key)).otherwise(cat("/NC/x/home/", text(key)))
    return responses(keyed(spark, sf, "orders"), fv.REDFIN, "details", body, entity_id=asked)


@query(
    "normalize_redfin_details",
    """SELECT CAST(k AS VARCHAR) AS listing_id, 'https://www.redfin.com'
        || CASE WHEN k % 2 = 0 THEN '' ELSE '/NC/x' END || '/home/' || k AS url,
      k || ' Oak' AS address, label AS city, kind AS state, '28704' AS zip, money AS price,
      CAST(k % 8 AS INTEGER) AS bedrooms, (k % 5) * CAST(0.5 AS DOUBLE) AS bathrooms,
      CAST(k % 4000 AS INTEGER) AS building_sqft,
      CASE WHEN k % 3 <> 0 THEN CAST(k % 9000 AS INTEGER) END AS lot_sqft, 2005 AS year_built,
      CASE WHEN k % 7 <> 0 THEN label || ' & more' END AS description,
      'https://f/' || k || '|https://s/1' AS image_urls, label AS listing_agent,
      CASE WHEN k % 2 = 0 THEN 'B & Co' END AS listing_brokerage,
      CAST(k % 4 AS INTEGER) AS days_on_market, CAST(NULL AS DOUBLE) AS hoa_fee
    FROM (SELECT o_orderkey AS k, o_orderpriority AS label, o_totalprice AS money,
      o_orderstatus AS kind FROM orders)""",
)
def normalize_redfin_details(spark, sf):
    rows = detail_tables(redfin_detail_responses(spark, sf), fv.REDFIN).rows
    return rows.drop("page", "pos").withColumn("image_urls", F.array_join("image_urls", "|"))


# ---- sunrealty ------------------------------------------------------------------------------

_SUN_TOWNS = list(dict.fromkeys(d for src, _, _, d in fv.TOWNS if src == fv.SUNREALTY))


def sunrealty_search_responses(spark, sf):
    def doc(i):
        return F.struct(
            F.when(i % 13 != 0, text(i)).alias("item_id"), F.when(i % 26 != 0, i + 3).alias("is_eid"),
            F.col("label").alias("ss_name"), cat("https://h/", text(i)).alias("ss_url"),
            beds(i).alias("is_nid$field_beds"), F.when(i % 6 != 0, i % 9 * 0.5).alias("fs_rc_core_lodging_product$baths"),
            (i % 20).cast("int").alias("is_rc_core_lodging_product$occ_total"),
            F.array(_pick(_SUN_TOWNS, F.col("key") % len(_SUN_TOWNS))).alias("sm_nid$rc_core_term_town$name"),
            F.when(i % 3 != 0, F.array(F.col("kind_text"), F.lit("z"))).alias("sm_nid$rc_core_term_community$name"),
            F.array(F.lit("Pool"), F.col("label")).alias("sm_nid$rc_core_term_featured_amenities$name"),
            F.when(i % 4 != 0, F.array(cat("https://t/", text(i)), F.lit("u"))).alias("sm_rc_core_item_teaser_slideshow"),
            F.lit("https://d").alias("ss_vrweb_default_image"),
        )

    key = F.col("key")
    body = F.when(key % 37 == 0, '{"response": {"numFound": 0}}').otherwise(
        cat('{"response": {"numFound": 3, "start": 0, "docs": ', F.to_json(home_list(doc)), "}}")
    )
    return responses(
        keyed(spark, sf, "orders"), fv.SUNREALTY, "search", body, page=key,
        check_in=F.when(key % 2 == 0, F.lit("2026-08-15")),
        params={"town": _pick(_SUN_TOWNS, key % len(_SUN_TOWNS))},
    )


_SUN = f"""
sun AS (
  SELECT CAST(CASE WHEN id % 13 <> 0 THEN id ELSE id + 3 END AS VARCHAR) AS listing_id,
    'https://h/' || id AS url, label AS name, {BEDS} AS bedrooms,
    CASE WHEN id % 6 <> 0 THEN CAST((id % 9) // 2 AS INTEGER) END AS bathrooms_full,
    CASE WHEN id % 6 <> 0 THEN CAST((id % 9) % 2 AS INTEGER) END AS bathrooms_half,
    CAST(id % 20 AS INTEGER) AS sleeps, {_pick_sql(_SUN_TOWNS, f"k % {len(_SUN_TOWNS)}")} AS town,
    CASE WHEN id % 3 <> 0 THEN kind_text END AS community, CAST(NULL AS VARCHAR) AS distance_to_beach,
    'Pool|' || label AS featured_amenities,
    CASE WHEN id % 4 <> 0 THEN 'https://t/' || id ELSE 'https://d' END AS image_url,
    CASE WHEN k % 2 = 0 THEN '2026-08-15' ELSE '' END AS check_in, CAST(k AS INTEGER) AS page, pos
  FROM homes WHERE k % 37 <> 0 AND id % 26 <> 0
)"""


@query("normalize_sunrealty_search", f"WITH {HOMES}, {_SUN} SELECT * FROM sun")
def normalize_sunrealty_search(spark, sf):
    rows = search_tables(sunrealty_search_responses(spark, sf), fv.SUNREALTY).rows
    return rows.withColumn("featured_amenities", F.array_join("featured_amenities", "|"))


@query(
    "search_sunrealty",
    f"""WITH {HOMES}, {_SUN} SELECT * EXCLUDE (page, pos) FROM sun
    WHERE town = 'Carova / 4x4 Beaches' AND coalesce(bedrooms, 0) >= 4 ORDER BY page, pos LIMIT 50""",
)
def search_sunrealty(spark, sf):
    rows = search_tables(sunrealty_search_responses(spark, sf), fv.SUNREALTY).rows
    found = plans.search_sunrealty(rows, "4x4", 4).rows
    return found.withColumn("featured_amenities", F.array_join("featured_amenities", "|"))


# ---- twiddy ------------------------------------------------------------------------------------

_TW_TOWNS = [s for src, s, _, _ in fv.TOWNS if src == fv.TWIDDY]


def twiddy_search_responses(spark, sf):
    def result(i):
        return F.struct(
            F.when(i % 13 != 0, i).otherwise(0).alias("propertyId"), F.col("label").alias("propertyName"),
            F.when(i % 4 == 0, "").otherwise(cat("/outer-banks/duck/pine-4x", text(i % 9), "/rentals/", text(i), "/")).alias("propertyUrl"),
            F.when(beds(i).isNotNull(), cat(text(beds(i)), " beds")).alias("bedrooms"),
            F.when(i % 3 == 0, "OceanFront").when(i % 3 == 1, F.col("kind_text")).otherwise("").alias("distanceToBeach"),
            F.when(i % 5 != 0, F.array(text(i), F.lit("q"))).alias("images"),
            F.array(F.struct(F.lit("x").alias("description")), F.struct(cat("Up (sleeps ", text(i % 30), ")").alias("description"))).alias("amenityItems"),
        )

    key = F.col("key")
    body = F.when(key % 41 == 0, "{}").otherwise(cat('{"results": ', F.to_json(home_list(result)), "}"))
    return responses(
        keyed(spark, sf, "orders"), fv.TWIDDY, "search", body, page=key,
        params={"town": _pick(_TW_TOWNS, key % 6)},
    )


_TW = f"""
tw AS (
  SELECT id AS listing_id, CASE WHEN id % 4 = 0 THEN '' ELSE
      'https://www.twiddy.com/outer-banks/duck/pine-4x' || (id % 9) || '/rentals/' || id || '/' END AS url,
    label AS name, {BEDS} AS bedrooms, CAST(NULL AS VARCHAR) AS bathrooms,
    {_pick_sql(_TW_TOWNS, "k % 6")} AS town,
    CASE WHEN id % 4 <> 0 THEN 'Pine 4X' || (id % 9) END AS neighborhood,
    CASE id % 3 WHEN 0 THEN 'OceanFront' WHEN 1 THEN kind_text END AS distance_to_beach,
    CASE WHEN id % 5 <> 0 THEN 'https://www.twiddy.com/property-images/' || id END AS image_url,
    id % 3 = 0 AS oceanfront, false AS pet_friendly, false AS private_pool,
    CAST(id % 30 AS INTEGER) AS sleeps, CAST(k AS INTEGER) AS page, pos
  FROM homes WHERE k % 41 <> 0 AND id % 13 <> 0
)"""


@query("normalize_twiddy_search", f"WITH {HOMES}, {_TW} SELECT * FROM tw")
def normalize_twiddy_search(spark, sf):
    return search_tables(twiddy_search_responses(spark, sf), fv.TWIDDY).rows


@query(
    "search_twiddy",
    f"""WITH {HOMES}, {_TW} SELECT * EXCLUDE (page, pos) FROM tw
    WHERE town = 'nags-head' AND coalesce(bedrooms, 0) >= 7 ORDER BY page, pos LIMIT 200""",
)
def search_twiddy(spark, sf):
    rows = search_tables(twiddy_search_responses(spark, sf), fv.TWIDDY).rows
    return plans.search_twiddy(rows, "Nags-Head ", 7, 200).rows


def twiddy_detail_responses(spark, sf):
    """Info, amenities and calendar per home; some side responses are missing."""
    rows = keyed(spark, sf, "orders")
    key, label = F.col("key"), F.col("label")
    info = F.to_json(F.struct(
        key.alias("propertyID"), label.alias("name"), F.lit("Southern Shores").alias("city"),
        cat("/outer-banks/", text(key)).alias("fullUrl"), F.col("kind_text").alias("neighborhood"),
        F.when(key % 3 != 0, label).alias("description"), F.when(key % 4 != 0, cat("https://e/", text(key))).alias("exteriorImage")))
    amenities = F.to_json(F.struct(
        F.struct(F.array(F.struct(label.alias("displayLabel")), F.struct(F.lit("").alias("displayLabel")), F.struct(F.lit("Pool").alias("displayLabel"))).alias("featuredAmenities")).alias("sectionModel"),
        cat(text(key % 9), " Full ", text(key % 3), " Half").alias("bathroomsSummary"),
        (key % 12).cast("int").alias("bedrooms"), (key % 30).cast("int").alias("sleepsCount")))

    def week(month):
        def one(n):
            day = F.date_add(F.lit("2026-05-02"), (month * 28 + n * 7).cast("int"))
            return F.struct(
                F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss").alias("arrive"),
                F.date_format(F.date_add(day, 7), "yyyy-MM-dd'T'HH:mm:ss").alias("depart"),
                F.when(n != 3, (key % 9000 + n).cast("double")).alias("weeklyRate"),
                cat("<s>$1</s>", text(n)).alias("weekContent"), ((key + n) % 2 == 0).alias("isAvailable"))
        return one

    months = F.transform(
        F.sequence(F.lit(0), (key % 2).cast("int")),
        lambda m: F.struct(F.transform(F.sequence(F.lit(0), F.lit(3)), week(m)).alias("weeks")))
    calendar = F.to_json(F.struct(F.array(F.struct(months.alias("months"))).alias("availabilityYears")))
    asked = text(key)
    return (
        responses(rows, fv.TWIDDY, "info", F.when(key % 43 == 0, "{}").otherwise(info), entity_id=asked)
        .unionByName(responses(rows.filter(key % 5 != 0), fv.TWIDDY, "amenities", amenities, entity_id=asked))
        .unionByName(responses(rows.filter(key % 7 != 0), fv.TWIDDY, "calendar", calendar, entity_id=asked))
    )


def _twiddy_details(spark, sf):
    return detail_tables(twiddy_detail_responses(spark, sf), fv.TWIDDY).rows


@query(
    "normalize_twiddy_details",
    """SELECT k AS listing_id, 'https://www.twiddy.com/outer-banks/' || k AS url, label AS name,
      'southern-shores' AS town, kind AS neighborhood,
      CASE WHEN k % 5 <> 0 THEN CAST(k % 12 AS INTEGER) END AS bedrooms,
      CASE WHEN k % 5 <> 0 THEN CAST(k % 9 AS INTEGER) END AS bathrooms_full,
      CASE WHEN k % 5 <> 0 THEN CAST(k % 3 AS INTEGER) END AS bathrooms_half,
      CASE WHEN k % 5 <> 0 THEN CAST(k % 30 AS INTEGER) END AS sleeps,
      CASE WHEN k % 3 <> 0 THEN label ELSE '' END AS description,
      CASE WHEN k % 5 <> 0 THEN label || '|Pool' ELSE '' END AS amenities,
      CASE WHEN k % 4 <> 0 THEN 'https://e/' || k ELSE '' END AS image_urls,
      CAST(CASE WHEN k % 7 = 0 THEN 0 ELSE 4 * (1 + k % 2) END AS INTEGER) AS weeks
    FROM (SELECT o_orderkey AS k, o_orderpriority AS label, o_orderstatus AS kind FROM orders)
    WHERE k % 43 <> 0""",
)
def normalize_twiddy_details(spark, sf):
    rows = _twiddy_details(spark, sf)
    plain = [c for c in rows.columns if c not in ("amenities", "image_urls", "weekly_rates", "page", "pos")]
    return rows.select(
        *plain, *joined("amenities", "image_urls"), F.size("weekly_rates").alias("weeks")
    )


@query(
    "explode_calendar",
    """SELECT k AS listing_id, CAST(m * 4 + n AS INTEGER) AS pos,
      strftime(DATE '2026-05-02' + CAST(m * 28 + n * 7 AS INTEGER), '%Y-%m-%d') AS arrive,
      strftime(DATE '2026-05-09' + CAST(m * 28 + n * 7 AS INTEGER), '%Y-%m-%d') AS depart,
      CASE WHEN n <> 3 THEN CAST(k % 9000 + n AS DOUBLE) END AS weekly_rate,
      (k + n) % 2 = 0 AS is_available, '$1 ' || n AS week_content
    FROM (SELECT o_orderkey AS k FROM orders), (SELECT unnest(range(2)) AS m),
      (SELECT unnest(range(4)) AS n)
    WHERE m <= k % 2 AND k % 43 <> 0 AND k % 7 <> 0""",
)
def explode_calendar(spark, sf):
    return child_tables(_twiddy_details(spark, sf), fv.TWIDDY)["weekly_rates"]


def twiddy_pages(spark, sf):
    """Landed pages whose URL does not hold the home's id; the body does."""
    key = F.col("key")
    body = cat('<html><script>var page = {"propertyId":"', text(key), '"};</script></html>')
    return responses(
        keyed(spark, sf, "orders"), fv.TWIDDY, "page", body,
        entity_id=cat("/outer-banks/home-", text(key * 7), "/"),
    )


@query(
    "details_by_page_id",
    """SELECT CASE WHEN k % 5 = 0 THEN CAST(k AS VARCHAR)
        WHEN k % 2 = 0 THEN '/outer-banks/' || k
        ELSE 'https://www.twiddy.com/outer-banks/home-' || (k * 7) END AS identifier,
      CASE WHEN k % 5 = 0 THEN 'id' WHEN k % 2 = 0 THEN 'url' ELSE 'page' END AS found_by,
      k AS listing_id, label AS name
    FROM (SELECT o_orderkey AS k, o_orderpriority AS label FROM orders) WHERE k % 43 <> 0""",
)
def details_by_page_id(spark, sf):
    key = F.col("o_orderkey")
    requests = table(spark, sf, "orders").select(
        F.when(key % 5 == 0, text(key))
        .when(key % 2 == 0, cat("/outer-banks/", text(key)))
        .otherwise(cat("https://www.twiddy.com/outer-banks/home-", text(key * 7)))
        .alias("identifier")
    )
    pages = twiddy_pages(spark, sf).select("entity_id", "body")
    found = find_all_details(requests, _twiddy_details(spark, sf), fv.TWIDDY, pages=pages)
    return found.select("identifier", "found_by", "listing_id", "name")
