"""Nightly stays: search pages and listing pages with embedded JSON state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions import arrays, dates, ids, numbers, text, urls
from listinglake.functions.embedded import script_json
from listinglake.functions.nulls import first_or, present, text_or_empty, truthy
from listinglake.schemas import CARRIED, ORDER_COLUMNS, to_record
from listinglake.sources.landing import (
    REQUEST_COLUMNS, explode_items, known, payload_table, pick, record_table, status_drift, usable_body,
)

STATE = "$.niobeClientData[0][1].data"

SEARCH_RESULTS = """
    searchResults ARRAY<STRUCT<
        demandStayListing: STRUCT<id: STRING,
            location: STRUCT<coordinate: STRUCT<latitude: DOUBLE, longitude: DOUBLE>>>,
        structuredContent: STRUCT<primaryLine: ARRAY<STRUCT<body: STRING>>>,
        structuredDisplayPrice: STRUCT<
            primaryLine: STRUCT<discountedPrice: STRING, price: STRING>>,
        title: STRING, subtitle: STRING, nameLocalized: STRING,
        avgRatingLocalized: STRING,
        contextualPictures: ARRAY<STRUCT<picture: STRING>>>>
"""

# One struct covers every section kind; a section fills only its own fields.
SECTION = {
    "title": "STRING", "subtitle": "STRING", "lat": "DOUBLE", "lng": "DOUBLE", "about": "STRING",
    "htmlDescription": "STRUCT<htmlText: STRING>", "maxGuestCapacity": "STRING",
    "arrangementDetails": "ARRAY<STRUCT<title: STRING, subtitle: STRING>>",
    "seeAllAmenitiesGroups": """ARRAY<STRUCT<
        amenities: ARRAY<STRUCT<title: STRING, available: BOOLEAN>>>>""",
    "cardData": """STRUCT<name: STRING, isSuperhost: BOOLEAN, isVerified: BOOLEAN,
        stats: ARRAY<STRUCT<type: STRING, value: STRING>>>""",
    "ratings": "ARRAY<STRUCT<label: STRING, localizedRating: STRING>>",
    "overallRating": "DOUBLE", "overallCount": "STRING", "isGuestFavorite": "BOOLEAN",
    "houseRules": "ARRAY<STRUCT<title: STRING>>", "cancellationPolicyForDisplay": "STRING",
    "highlights": "ARRAY<STRUCT<title: STRING, subtitle: STRING>>",
    "previewImages": "ARRAY<STRUCT<baseUrl: STRING>>",
}
# What a job that only wants some columns need read of the sections; of others, all is read.
READ_FOR = {
    "listing_id": [],
    "amenities": ["seeAllAmenitiesGroups"],
    "unavailable_amenities": ["seeAllAmenitiesGroups"],
    "image_urls": ["previewImages"],
}


def _few(columns: list[str] | None) -> bool:
    return columns is not None and READ_FOR.keys() >= set(columns)


def detail_state(columns: list[str] | None = None) -> str:
    read = {field for c in columns for field in READ_FOR[c]} if _few(columns) else SECTION.keys()
    fields = ", ".join(f"{name}: {kind}" for name, kind in SECTION.items() if name in read)
    section = f"sectionId: STRING, section: STRUCT<{fields}>" if fields else "sectionId: STRING"
    return f"""
        presentation STRUCT<stayProductDetailPage: STRUCT<sections: STRUCT<
            sections: ARRAY<STRUCT<{section}>>>>>,
        node STRUCT<pdpPresentation: STRUCT<mediaTour: STRUCT<
            stops: ARRAY<STRUCT<items: ARRAY<STRUCT<image: STRUCT<uri: STRING>>>>>>>>
    """


def search_payloads(responses: DataFrame) -> DataFrame:
    df = (
        pick(responses, fv.STAYS, "search")
        .select(
            *REQUEST_COLUMNS,
            script_json(usable_body(), fv.STAYS_STATE_SCRIPT).alias("state"),
        )
        .withColumn(
            "results",
            F.get_json_object("state", f"{STATE}.presentation.staysSearch.results"),
        )
    )
    return payload_table(
        df,
        status_drift(
            (F.col("state").isNull(), "page has no embedded state"),
            (F.col("results").isNull(), "missing staysSearch.results"),
        ),
        F.from_json("results", SEARCH_RESULTS)["searchResults"],
    )


def listings(payloads: DataFrame, keep: list[str] = ORDER_COLUMNS) -> DataFrame:
    item = F.col("item")
    lines = F.transform(
        item["structuredContent"]["primaryLine"], lambda m: m["body"]
    )
    price_line = item["structuredDisplayPrice"]["primaryLine"]
    place = item["demandStayListing"]["location"]["coordinate"]
    rows = explode_items(payloads, keep).select(
        *CARRIED,
        ids.decode_stay_id(item["demandStayListing"]["id"]).alias("listing_id"),
        text_or_empty(item["subtitle"], item["nameLocalized"]).alias("name"),
        text_or_empty(item["title"]).alias("property_type"),
        numbers.int_from_text(arrays.keyword_line(lines, "bedroom")).alias("bedrooms"),
        numbers.int_from_text(
            arrays.keyword_line(lines, "bed", exclude="bedroom")
        ).alias("beds"),
        numbers.float_from_text(arrays.keyword_line(lines, "bath")).alias("bathrooms"),
        place["latitude"].alias("latitude"),
        place["longitude"].alias("longitude"),
        numbers.float_from_text(present(item["avgRatingLocalized"])).alias("rating"),
        numbers.review_count(item["avgRatingLocalized"]).alias("review_count"),
        dates.iso(F.col("check_in")).alias("check_in"),
        dates.iso(dates.check_out(F.col("check_in"), F.col("nights"))).alias("check_out"),
        "nights",
        F.coalesce(
            present(price_line["discountedPrice"]), price_line["price"]
        ).alias("price_display"),
        first_or(
            F.transform(item["contextualPictures"], lambda p: p["picture"]), F.lit(None)
        ).alias("image_url"),
    )
    priced = (
        rows.filter(known("listing_id"))
        .withColumn("_price", numbers.price_and_currency(present(F.col("price_display"))))
        .withColumn("total_price", F.col("_price.amount"))
        .withColumn("price_currency", F.col("_price.currency"))
        .withColumn("url", urls.from_id(fv.STAYS_BASE + "/rooms", F.col("listing_id")))
    )
    return to_record(priced, "stays_listing", keep=keep)


def detail_payloads(responses: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``columns``: those of the details that the job wants, all if not told."""
    df = (
        pick(responses, fv.STAYS, "details")
        .select(
            *REQUEST_COLUMNS,
            script_json(usable_body(), fv.STAYS_STATE_SCRIPT).alias("state"),
        )
        .withColumn("data", F.from_json(F.get_json_object("state", STATE), detail_state(columns)))
    )
    sections = F.col("data.presentation.stayProductDetailPage.sections.sections")
    return record_table(
        df,
        status_drift(
            (F.col("state").isNull(), "page has no embedded state"),
            (sections.isNull(), "missing stayProductDetailPage sections"),
        ),
        {"sections": sections, "node": F.col("data.node")},
    )


def details(
    payloads: DataFrame, keep: list[str] = ORDER_COLUMNS, columns: list[str] | None = None
) -> DataFrame:
    """With few ``columns``, ``listing_id`` and these only; other fields are not parsed then."""
    named = F.filter("item.sections", lambda s: present(s["sectionId"]).isNotNull())
    by_id = arrays.pairs_to_map(
        F.transform(
            named, lambda s: F.struct(s["sectionId"].alias("key"), s["section"].alias("value"))
        )
    )
    df = explode_items(payloads, keep).withColumns(
        {"listing_id": ids.stays_id(F.col("entity_id")), "by_id": by_id}
    )

    def section(section_id: str) -> Column:
        return F.try_element_at("by_id", F.lit(section_id))

    card = section("MEET_YOUR_HOST")["cardData"]
    counts = F.transform(
        F.filter(card["stats"], lambda s: s["type"] == "REVIEW_COUNT"),
        lambda s: F.replace(s["value"], F.lit(","), F.lit("")).try_cast("int"),
    )
    amenities = F.filter(
        F.flatten(
            F.transform(
                F.filter(
                    section("AMENITIES_DEFAULT")["seeAllAmenitiesGroups"],
                    lambda g: g["amenities"].isNotNull(),
                ),
                lambda g: g["amenities"],
            )
        ),
        lambda a: present(a["title"]).isNotNull(),
    )

    def titles(arr: Column) -> Column:
        return arrays.or_empty(F.transform(arr, lambda a: a["title"]))

    either = lambda h: present(h["title"]).isNotNull() | present(h["subtitle"]).isNotNull()
    ratings = F.transform(
        F.filter(
            section("REVIEWS_DEFAULT")["ratings"],
            lambda r: present(r["label"]).isNotNull()
            & present(r["localizedRating"]).isNotNull(),
        ),
        lambda r: F.struct(r["label"].alias("key"), r["localizedRating"].alias("value")),
    )
    no_pairs = F.array().cast("array<struct<key: string, value: string>>")
    tour = F.flatten(
        F.transform(
            F.filter(
                F.col("item.node.pdpPresentation.mediaTour.stops"),
                lambda s: s["items"].isNotNull(),
            ),
            lambda s: F.transform(s["items"], lambda i: i["image"]["uri"]),
        )
    )
    # Not from the map: a job that wants only images need not make one of all sections.
    last_hero = arrays.last_where("item.sections", lambda s: s["sectionId"] == "HERO_DEFAULT")
    hero = F.transform(last_hero["section"]["previewImages"], lambda p: p["baseUrl"])
    lists = {
        "amenities": titles(F.filter(amenities, lambda a: truthy(a["available"]))),
        "unavailable_amenities": titles(F.filter(amenities, lambda a: ~truthy(a["available"]))),
        "image_urls": arrays.ordered_distinct(hero, tour),
    }
    if _few(columns):
        names = [c for c in columns if c in lists]
        rows = df.select(*CARRIED, "listing_id", *[lists[c].alias(c) for c in names])
        return to_record(rows, "stays_details", keep=keep).select("listing_id", *names, *keep)
    rows = df.select(
        *CARRIED,
        "listing_id",
        urls.from_id(fv.STAYS_BASE + "/rooms", F.col("listing_id")).alias("url"),
        text_or_empty(section("TITLE_DEFAULT")["title"]).alias("title"),
        text.strip_html(
            section("DESCRIPTION_DEFAULT")["htmlDescription"]["htmlText"]
        ).alias("description"),
        numbers.whole(section("BOOK_IT_SIDEBAR")["maxGuestCapacity"]).alias("max_guests"),
        arrays.or_empty(
            F.transform(
                F.filter(
                    section("SLEEPING_ARRANGEMENT_WITH_IMAGES")["arrangementDetails"],
                    either,
                ),
                lambda a: text.title_subtitle(a["title"], a["subtitle"]),
            )
        ).alias("sleeping_arrangements"),
        section("LOCATION_DEFAULT")["subtitle"].alias("location_subtitle"),
        section("LOCATION_DEFAULT")["lat"].alias("latitude"),
        section("LOCATION_DEFAULT")["lng"].alias("longitude"),
        card["name"].alias("host_name"),
        truthy(card["isSuperhost"]).alias("host_is_superhost"),
        truthy(card["isVerified"]).alias("host_is_verified"),
        section("MEET_YOUR_HOST")["about"].alias("host_about"),
        arrays.last_where(counts, lambda n: n.isNotNull()).alias("host_review_count"),
        section("REVIEWS_DEFAULT")["overallRating"].alias("overall_rating"),
        numbers.whole(section("REVIEWS_DEFAULT")["overallCount"]).alias("review_count"),
        arrays.pairs_to_map(F.coalesce(ratings, no_pairs)).alias("rating_breakdown"),
        truthy(section("REVIEWS_DEFAULT")["isGuestFavorite"]).alias("is_guest_favorite"),
        lists["amenities"].alias("amenities"),
        lists["unavailable_amenities"].alias("unavailable_amenities"),
        arrays.or_empty(
            F.filter(section("HIGHLIGHTS_DEFAULT")["highlights"], either),
            "struct<title: string, subtitle: string>",
        ).alias("highlights"),
        arrays.keep_present(
            F.transform(section("POLICIES_DEFAULT")["houseRules"], lambda r: r["title"])
        ).alias("house_rules"),
        section("POLICIES_DEFAULT")["cancellationPolicyForDisplay"].alias(
            "cancellation_policy"
        ),
        lists["image_urls"].alias("image_urls"),
    )
    return to_record(rows, "stays_details", keep=keep)
