"""Commercial listings: one search call, and details with two side lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions import arrays, ids, nulls, numbers, text, urls
from listinglake.functions.nulls import text_or_empty
from listinglake.operators.joins import left_or_empty
from listinglake.schemas import CARRIED, ORDER_COLUMNS, to_record
from listinglake.sources.landing import (
    REQUEST_COLUMNS, explode_items, fetch_order, latest, payload_table,
    pick, record_table, status_drift, status_to_rows, usable_body,
)

# ``state`` is an object with a code, or plain text; read it as text.
LOCATIONS = "ARRAY<STRUCT<address: STRING, city: STRING, state: STRING, zip: STRING>>"

SEARCH = f"""data ARRAY<STRUCT<
    id: STRING, name: STRING, thumbnailUrl: STRING, urlSlug: STRING,
    askingPrice: STRING, squareFootage: STRING, types: ARRAY<STRING>,
    locations: {LOCATIONS}>>"""

DETAILS = f"""urlSlug STRING, name STRING, marketingDescription STRING,
    description STRING, types ARRAY<STRING>, askingPrice STRING,
    details MAP<STRING, STRING>,
    summaryDetails ARRAY<STRUCT<key: STRING, value: STRING>>,
    locations {LOCATIONS}"""


def first_location(locations: Column) -> Column:
    """First location -> struct(address, city, state, zip); no location -> four ''."""
    loc = F.get(locations, F.lit(0))
    state = F.when(
        loc["state"].startswith("{"), F.get_json_object(loc["state"], "$.code")
    ).otherwise(loc["state"])
    return F.struct(
        text_or_empty(loc["address"]).alias("address"),
        text_or_empty(loc["city"]).alias("city"),
        text_or_empty(state).alias("state"),
        text_or_empty(loc["zip"]).alias("zip"),
    )


def search_payloads(responses: DataFrame) -> DataFrame:
    df = pick(responses, fv.CREXI, "search").select(
        *REQUEST_COLUMNS, F.from_json(usable_body(), SEARCH).alias("data")
    )
    items = F.col("data.data")
    return payload_table(
        df,
        status_drift(
            (items.isNull(), "missing data list"),
            (F.exists(items, lambda i: i["id"].isNull()), "missing id"),
        ),
        items,
    )


def listings(payloads: DataFrame, keep: list[str] = ORDER_COLUMNS) -> DataFrame:
    item = F.col("item")
    place = first_location(item["locations"])
    rows = explode_items(payloads, keep).select(
        *CARRIED,
        F.col("params")["query"].alias("query"),
        item["id"].alias("listing_id"),
        urls.from_slug(fv.CREXI_BASE, item["urlSlug"], item["id"]).alias("url"),
        text_or_empty(item["name"]).alias("name"),
        *[place[c].alias(c) for c in ("address", "city", "state", "zip")],
        item["askingPrice"].try_cast("double").alias("price"),
        text.join_list(item["types"]).alias("property_type"),
        numbers.whole(item["squareFootage"]).alias("building_sqft"),
        item["thumbnailUrl"].alias("image_url"),
    )
    return to_record(rows, "crexi_listing", keep=[*keep, "query"])


def detail_payloads(responses: DataFrame) -> DataFrame:
    """Newest asset payloads joined with the gallery and broker lists of the asset."""

    def side(kind: str, schema: str, value) -> DataFrame:
        entries = F.from_json("body", f"ARRAY<STRUCT<{schema}>>")
        rows = arrays.keep_present(F.transform(entries, value))
        return latest(
            pick(responses, fv.CREXI, kind).select(
                "entity_id", *fetch_order(kind), status_to_rows(kind, rows).alias(kind)
            )
        )

    assets = latest(
        pick(responses, fv.CREXI, "details").select(
            *REQUEST_COLUMNS,
            *fetch_order(),
            F.from_json("body", DETAILS).alias("data"),
            F.trim("body").startswith("{").alias("is_object"),
        )
    )
    joined = left_or_empty(
        assets,
        {
            "gallery": side("gallery", "imageUrl: STRING", lambda e: e["imageUrl"]),
            "brokers": side(
                "brokers",
                "firstName: STRING, lastName: STRING",
                lambda e: text.full_name(e["firstName"], e["lastName"]),
            ),
        },
        "entity_id",
    )
    return record_table(
        joined,
        status_drift((~F.col("is_object"), "asset is not an object")),
        {name: F.col(name) for name in ("data", "gallery", "brokers")},
        chosen=True,
    )


def details(payloads: DataFrame, keep: list[str] = ORDER_COLUMNS) -> DataFrame:
    asset = F.col("item.data")
    place = first_location(asset["locations"])
    sqft = F.coalesce(
        nulls.safe_int(nulls.keyed_value(asset["summaryDetails"], "SquareFootage")),
        F.replace(
            F.try_element_at(asset["details"], F.lit("Square Footage")),
            F.lit(","), F.lit(""),
        ).try_cast("int"),
    )
    df = explode_items(payloads, keep).withColumn("listing_id", ids.crexi_id(F.col("entity_id")))
    rows = df.select(
        *CARRIED,
        "listing_id",
        urls.from_slug(fv.CREXI_BASE, asset["urlSlug"], F.col("listing_id")).alias("url"),
        text_or_empty(asset["name"]).alias("name"),
        *[place[c].alias(c) for c in ("address", "city", "state", "zip")],
        asset["askingPrice"].alias("price"),
        text.join_list(asset["types"]).alias("property_type"),
        text.strip_html(
            text_or_empty(asset["marketingDescription"], asset["description"]),
            entities=False,
        ).alias("description"),
        sqft.alias("building_sqft"),
        nulls.map_decimal(asset["details"], fv.LOT_ACRE_KEYS).alias("lot_acres"),
        nulls.map_first_present(asset["details"], fv.YEAR_KEYS).alias("year_built"),
        F.col("item.gallery").alias("image_urls"),
        F.col("item.brokers").alias("broker_names"),
    )
    return to_record(rows, "crexi_details", keep=keep)
