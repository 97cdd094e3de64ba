"""Town search, and details put together from info, amenities and calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions import arrays, dates, ids, numbers, text, urls
from listinglake.functions.nulls import equals_ci, first_or, present, text_or_empty, truthy
from listinglake.operators.joins import combine_left
from listinglake.schemas import CARRIED, ORDER_COLUMNS, to_record
from listinglake.sources.landing import (
    REQUEST_COLUMNS, explode_items, known, fetch_order, latest,
    payload_table, pick, record_table, status_drift, usable_body,
)

SEARCH = """results ARRAY<STRUCT<
    propertyId: STRING, propertyName: STRING, propertyUrl: STRING, town: STRING,
    bedrooms: STRING, distanceToBeach: STRING, images: ARRAY<STRING>,
    amenityItems: ARRAY<STRUCT<description: STRING>>>>"""

INFO = """propertyID STRING, name STRING, city STRING, fullUrl STRING,
    neighborhood STRING, description STRING, exteriorImage STRING"""

AMENITIES = """sectionModel STRUCT<featuredAmenities: ARRAY<STRUCT<displayLabel: STRING>>>,
    bathroomsSummary STRING, bedrooms STRING, sleepsCount STRING"""

CALENDAR = """availabilityYears ARRAY<STRUCT<months: ARRAY<STRUCT<weeks: ARRAY<STRUCT<
    arrive: STRING, depart: STRING, weekContent: STRING, weeklyRate: STRING,
    isAvailable: BOOLEAN>>>>>>"""


def search_payloads(responses: DataFrame) -> DataFrame:
    df = pick(responses, fv.TWIDDY, "search").select(
        *REQUEST_COLUMNS, F.from_json(usable_body(), SEARCH).alias("data")
    )
    return payload_table(
        df,
        status_drift((F.col("data.results").isNull(), "missing results")),
        F.col("data.results"),
    )


def listings(payloads: DataFrame, keep: list[str] = ORDER_COLUMNS) -> DataFrame:
    item = F.col("item")
    rows = (
        explode_items(payloads, keep)
        .withColumn("id", F.nullif(numbers.whole(item["propertyId"], "bigint"), F.lit(0)))
        .filter(known("id"))
        .select(
            *CARRIED,
            numbers.whole(item["propertyId"], "bigint").alias("listing_id"),
            urls.absolute_path(text_or_empty(item["propertyUrl"]), fv.TWIDDY_BASE).alias("url"),
            text_or_empty(item["propertyName"]).alias("name"),
            numbers.beds_text(item["bedrooms"]).alias("bedrooms"),
            F.coalesce(present(item["town"]), F.col("params")["town"]).alias("town"),
            text.neighborhood(item["propertyUrl"]).alias("neighborhood"),
            present(item["distanceToBeach"]).alias("distance_to_beach"),
            urls.image_from_token(first_or(item["images"], F.lit(None))).alias("image_url"),
            equals_ci(item["distanceToBeach"], "oceanfront").alias("oceanfront"),
            F.lit(False).alias("pet_friendly"),
            F.lit(False).alias("private_pool"),
            numbers.sleeps_in_list(
                F.transform(item["amenityItems"], lambda a: a["description"])
            ).alias("sleeps"),
        )
    )
    return to_record(rows, "twiddy_listing", keep=keep)


def detail_payloads(responses: DataFrame) -> DataFrame:
    """Newest info payloads joined with amenities and calendar of the same home."""

    def newest(kind: str, schema: str, columns: list[str]) -> DataFrame:
        return latest(
            pick(responses, fv.TWIDDY, kind).select(
                *columns, *fetch_order(), F.from_json("body", schema).alias(kind)
            )
        )

    joined = combine_left(
        newest("info", INFO, REQUEST_COLUMNS),
        [
            newest("amenities", AMENITIES, ["entity_id"]),
            newest("calendar", CALENDAR, ["entity_id"]),
        ],
        "entity_id",
    )
    return record_table(
        joined,
        status_drift(
            (numbers.whole(F.col("info.propertyID"), "bigint").isNull(), "missing propertyID")
        ),
        {name: F.col(name) for name in ("info", "amenities", "calendar")},
        chosen=True,
    )


def details(payloads: DataFrame, keep: list[str] = ORDER_COLUMNS) -> DataFrame:
    info, extra = F.col("item.info"), F.col("item.amenities")
    baths = numbers.baths_words(extra["bathroomsSummary"])
    months = F.flatten(
        F.transform(
            F.filter(
                F.col("item.calendar.availabilityYears"), lambda y: y["months"].isNotNull()
            ),
            lambda y: y["months"],
        )
    )
    weeks = F.flatten(
        F.transform(
            F.filter(months, lambda m: m["weeks"].isNotNull()), lambda m: m["weeks"]
        )
    )
    rates = F.transform(
        weeks,
        lambda w: F.struct(
            dates.day_of_timestamp_text(w["arrive"]).alias("arrive"),
            dates.day_of_timestamp_text(w["depart"]).alias("depart"),
            w["weeklyRate"].try_cast("double").alias("weekly_rate"),
            truthy(w["isAvailable"]).alias("is_available"),
            text.strip_html(w["weekContent"]).alias("week_content"),
        ),
    )
    rows = explode_items(payloads, keep).select(
        *CARRIED,
        # A response landed under its URL has the id only inside.
        F.coalesce(
            ids.twiddy_id(F.col("entity_id")), numbers.whole(info["propertyID"], "bigint")
        ).alias("listing_id"),
        urls.absolute_path(text_or_empty(info["fullUrl"]), fv.TWIDDY_BASE).alias("url"),
        text_or_empty(info["name"]).alias("name"),
        text.town_slug(text_or_empty(info["city"])).alias("town"),
        info["neighborhood"].alias("neighborhood"),
        numbers.whole(extra["bedrooms"]).alias("bedrooms"),
        baths["full"].alias("bathrooms_full"),
        baths["half"].alias("bathrooms_half"),
        numbers.whole(extra["sleepsCount"]).alias("sleeps"),
        text_or_empty(info["description"]).alias("description"),
        arrays.keep_present(
            F.transform(
                extra["sectionModel"]["featuredAmenities"], lambda a: a["displayLabel"]
            )
        ).alias("amenities"),
        arrays.keep_present(F.array(info["exteriorImage"])).alias("image_urls"),
        F.coalesce(
            rates,
            F.array().cast(
                "array<struct<arrive: string, depart: string, weekly_rate: double,"
                " is_available: boolean, week_content: string>>"
            ),
        ).alias("weekly_rates"),
    )
    return to_record(rows, "twiddy_details", keep=keep)
