"""Town search results and property details with one price per arrival week."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions import arrays, numbers, text, urls
from listinglake.functions.nulls import (
    first_present, null_if_in, present, text_or_empty, truthy,
)
from listinglake.schemas import CARRIED, ORDER_COLUMNS, to_record
from listinglake.sources.landing import (
    REQUEST_COLUMNS, explode_items, known, payload_table, pick, record_table, status_drift, usable_body,
)

SEARCH = """Title STRING, Results ARRAY<STRUCT<
    Propid: STRING, Propname: STRING, Bedrooms: STRING, Baths: STRING, PropURL: STRING,
    DisplayLocation: STRING, DisplaySub: STRING, ImageURL: STRING,
    PetFriendly: BOOLEAN, PrivatePool: BOOLEAN>>"""

DETAILS = """Propid STRING, Propname STRING, Area STRING, NumBedrooms STRING,
    Bathroominfo ARRAY<STRING>, Sleeps STRING, Description STRING,
    Sidebar ARRAY<STRUCT<Items: ARRAY<STRING>>>,
    PicsLarge ARRAY<STRUCT<ImgUrl: STRING>>,
    Weeks1CurrAvail ARRAY<STRUCT<
        ArrivalDate: STRING, Rate: STRING, CostPerNight: STRING, BookType: STRING>>,
    MinPrice STRING, MaxPrice STRING, CanonicalUrl STRING"""

DETAIL_PAGE = fv.CAROLINADESIGNS_BASE + "/property-detail-page"


def search_payloads(responses: DataFrame) -> DataFrame:
    df = pick(responses, fv.CAROLINADESIGNS, "search").select(
        *REQUEST_COLUMNS, F.from_json(usable_body(), SEARCH).alias("data")
    )
    return payload_table(
        df,
        status_drift((F.col("data.Results").isNull(), "missing Results")),
        F.col("data.Results"),
    )


def listings(payloads: DataFrame, keep: list[str] = ORDER_COLUMNS) -> DataFrame:
    item = F.col("item")
    baths = numbers.baths_slash(item["Baths"])
    rows = (
        explode_items(payloads, keep)
        .withColumn("listing_id", present(text.strip(item["Propid"])))
        .filter(known("listing_id"))
        .select(
            *CARRIED,
            "listing_id",
            F.coalesce(
                present(urls.absolute_unless_http(item["PropURL"], fv.CAROLINADESIGNS_BASE)),
                urls.from_id(DETAIL_PAGE, F.col("listing_id")),
            ).alias("url"),
            text_or_empty(item["Propname"]).alias("name"),
            numbers.whole(item["Bedrooms"]).alias("bedrooms"),
            baths["full"].alias("bathrooms_full"),
            baths["half"].alias("bathrooms_half"),
            F.col("params")["town"].alias("town"),
            item["DisplayLocation"].alias("location"),
            item["DisplaySub"].alias("subdivision"),
            item["ImageURL"].alias("image_url"),
            truthy(item["PetFriendly"]).alias("pet_friendly"),
            truthy(item["PrivatePool"]).alias("private_pool"),
        )
    )
    return to_record(rows, "carolinadesigns_listing", keep=keep)


def detail_payloads(responses: DataFrame) -> DataFrame:
    df = pick(responses, fv.CAROLINADESIGNS, "details").select(
        *REQUEST_COLUMNS, F.from_json(usable_body(), DETAILS).alias("data")
    )
    names = df.schema["data"].dataType.fieldNames()
    return record_table(
        df,
        status_drift((F.col("data.Propid").isNull(), "missing Propid")),
        {name: F.col("data")[name] for name in names},
    )


def details(payloads: DataFrame, keep: list[str] = ORDER_COLUMNS) -> DataFrame:
    item = F.col("item")
    baths = numbers.baths_labelled(item["Bathroominfo"])
    weeks = F.transform(
        item["Weeks1CurrAvail"],
        lambda w: F.struct(
            text_or_empty(w["ArrivalDate"]).alias("arrival_date"),
            null_if_in(w["Rate"], ["$0.00", ""]).alias("weekly_rate"),
            w["CostPerNight"].alias("nightly_rate"),
            present(w["BookType"]).alias("book_type"),
        ),
    )
    items = F.flatten(
        F.transform(
            F.filter(item["Sidebar"], lambda s: s["Items"].isNotNull()),
            lambda s: s["Items"],
        )
    )
    rows = explode_items(payloads, keep).select(
        *CARRIED,
        item["Propid"].alias("listing_id"),
        F.coalesce(
            first_present(item["CanonicalUrl"]),
            urls.from_id(DETAIL_PAGE, F.col("entity_id")),
        ).alias("url"),
        text_or_empty(item["Propname"]).alias("name"),
        text.town_slug(text_or_empty(item["Area"])).alias("town"),
        numbers.leading_int(item["NumBedrooms"]).alias("bedrooms"),
        baths["full"].alias("bathrooms_full"),
        baths["half"].alias("bathrooms_half"),
        numbers.leading_int(item["Sleeps"]).alias("sleeps"),
        text.strip_html(item["Description"]).alias("description"),
        arrays.keep_present(items).alias("amenities"),
        arrays.keep_present(
            F.transform(item["PicsLarge"], lambda p: p["ImgUrl"])
        ).alias("image_urls"),
        F.coalesce(
            weeks,
            F.array().cast(
                "array<struct<arrival_date: string, weekly_rate: string,"
                " nightly_rate: string, book_type: string>>"
            ),
        ).alias("weekly_rates"),
        numbers.whole(item["MinPrice"]).alias("min_price"),
        numbers.whole(item["MaxPrice"]).alias("max_price"),
    )
    return to_record(rows, "carolinadesigns_details", keep=keep)
