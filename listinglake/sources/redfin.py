"""Home search and home pages whose data sits in an embedded response cache."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions import arrays, ids, text, urls
from listinglake.functions.embedded import (
    cache_payload, json_after_marker, ld_json_description,
)
from listinglake.functions.nulls import first_present, present, text_or_empty
from listinglake.schemas import CARRIED, ORDER_COLUMNS, to_record
from listinglake.sources.landing import (
    REQUEST_COLUMNS, explode_items, known, payload_table, pick, record_table, status_drift, usable_body,
)

VALUE_TEXT = "STRUCT<value: STRING>"
VALUE_NUMBER = "STRUCT<value: DOUBLE>"

SEARCH = f"""STRUCT<homes: ARRAY<STRUCT<
    propertyId: STRING, listingId: STRING, mlsId: {VALUE_TEXT}, dataSourceId: STRING,
    photoFormat: STRING, beds: DOUBLE, baths: DOUBLE, price: {VALUE_NUMBER},
    sqFt: {VALUE_NUMBER}, lotSize: {VALUE_NUMBER}, yearBuilt: {VALUE_NUMBER},
    city: STRING, state: STRING, zip: STRING, url: STRING,
    streetLine: {VALUE_TEXT}, unitNumber: {VALUE_TEXT}>>>"""

HOME = f"""STRUCT<
    addressSectionInfo: STRUCT<
        beds: DOUBLE, baths: DOUBLE, priceInfo: STRUCT<amount: DOUBLE>,
        sqFt: {VALUE_NUMBER}, lotSize: DOUBLE, yearBuilt: DOUBLE,
        streetAddress: STRUCT<assembledAddress: STRING>,
        city: STRING, state: STRING, zip: STRING, cumulativeDaysOnMarket: DOUBLE>,
    mediaBrowserInfo: STRUCT<photos: ARRAY<STRUCT<photoUrls: STRUCT<
        fullScreenPhotoUrl: STRING, nonFullScreenPhotoUrl: STRING>>>>>"""

AGENTS = """STRUCT<mainHouseInfo: STRUCT<listingAgents: ARRAY<STRUCT<
    agentInfo: STRUCT<agentName: STRING>, brokerName: STRING>>>>"""


def _with_cache(df: DataFrame, *extra: Column) -> DataFrame:
    state = json_after_marker(usable_body(), fv.REDFIN_STATE_MARKER)
    return df.select(
        *REQUEST_COLUMNS,
        *extra,
        F.from_json(
            state, "`ReactServerAgent.cache` STRUCT<dataCache: MAP<STRING, STRING>>"
        )["ReactServerAgent.cache"]["dataCache"].alias("cache"),
    )


def search_payloads(responses: DataFrame) -> DataFrame:
    df = _with_cache(pick(responses, fv.REDFIN, "search")).withColumn(
        "data", cache_payload(F.col("cache"), fv.REDFIN_SEARCH_KEY, SEARCH)
    )
    return payload_table(
        df,
        status_drift(
            (F.col("cache").isNull(), "no readable response cache"),
            (F.col("data.homes").isNull(), "missing homes list"),
        ),
        F.col("data.homes"),
    )


def listings(payloads: DataFrame, keep: list[str] = ORDER_COLUMNS) -> DataFrame:
    item = F.col("item")

    def whole(c: Column) -> Column:
        return c["value"].try_cast("int")

    rows = explode_items(payloads, keep).select(
        *CARRIED,
        F.col("params")["zip_code"].alias("zip_code"),
        ids.home_id(item["url"], item["propertyId"], item["listingId"]).alias("listing_id"),
        F.when(
            present(item["url"]).isNotNull(), F.concat(F.lit(fv.REDFIN_BASE), item["url"])
        ).otherwise("").alias("url"),
        text.street_unit(item["streetLine"]["value"], item["unitNumber"]["value"]).alias(
            "address"
        ),
        text_or_empty(item["city"]).alias("city"),
        text_or_empty(item["state"]).alias("state"),
        text_or_empty(item["zip"]).alias("zip"),
        item["price"]["value"].alias("price"),
        item["beds"].try_cast("int").alias("bedrooms"),
        item["baths"].alias("bathrooms"),
        whole(item["sqFt"]).alias("building_sqft"),
        whole(item["lotSize"]).alias("lot_sqft"),
        whole(item["yearBuilt"]).alias("year_built"),
        urls.home_photo(
            item["dataSourceId"], item["mlsId"]["value"], item["photoFormat"]
        ).alias("image_url"),
    ).filter(known("listing_id"))
    return to_record(rows, "redfin_listing", keep=[*keep, "zip_code"])


def detail_payloads(responses: DataFrame) -> DataFrame:
    df = (
        _with_cache(
            pick(responses, fv.REDFIN, "details"),
            ld_json_description(usable_body()).alias("description"),
        )
        .withColumn("home", cache_payload(F.col("cache"), fv.REDFIN_HOME_KEY, HOME))
        .withColumn("agents", cache_payload(F.col("cache"), fv.REDFIN_AGENT_KEY, AGENTS))
    )
    return record_table(
        df,
        status_drift(
            (F.col("cache").isNull(), "no readable response cache"),
            (F.col("home").isNull(), "missing home entry"),
            (F.col("home.addressSectionInfo").isNull(), "missing addressSectionInfo"),
        ),
        {name: F.col(name) for name in ("home", "agents", "description")},
    )


def home_page_url(c: Column) -> Column:
    asked = text.strip(c)
    return (
        F.when(asked.rlike(r"^\d+$"), urls.from_id(fv.REDFIN_BASE + "/home", asked))
        .when(asked.startswith("http"), asked)
        .otherwise(F.concat(F.lit(fv.REDFIN_BASE), asked))
    )


def details(payloads: DataFrame, keep: list[str] = ORDER_COLUMNS) -> DataFrame:
    info = F.col("item.home.addressSectionInfo")
    agent = F.get(F.col("item.agents.mainHouseInfo.listingAgents"), F.lit(0))
    photos = F.transform(
        F.col("item.home.mediaBrowserInfo.photos"),
        lambda p: first_present(
            p["photoUrls"]["fullScreenPhotoUrl"], p["photoUrls"]["nonFullScreenPhotoUrl"]
        ),
    )
    rows = explode_items(payloads, keep).select(
        *CARRIED,
        home_page_url(F.col("entity_id")).alias("url"),
        text_or_empty(info["streetAddress"]["assembledAddress"]).alias("address"),
        text_or_empty(info["city"]).alias("city"),
        text_or_empty(info["state"]).alias("state"),
        text_or_empty(info["zip"]).alias("zip"),
        info["priceInfo"]["amount"].alias("price"),
        info["beds"].try_cast("int").alias("bedrooms"),
        info["baths"].alias("bathrooms"),
        info["sqFt"]["value"].try_cast("int").alias("building_sqft"),
        info["lotSize"].try_cast("int").alias("lot_sqft"),
        info["yearBuilt"].try_cast("int").alias("year_built"),
        text.strip(text.html_unescape(F.col("item.description"))).alias("description"),
        arrays.ordered_distinct(photos).alias("image_urls"),
        present(agent["agentInfo"]["agentName"]).alias("listing_agent"),
        present(agent["brokerName"]).alias("listing_brokerage"),
        info["cumulativeDaysOnMarket"].try_cast("int").alias("days_on_market"),
    )
    return to_record(
        rows.withColumn("listing_id", ids.redfin_id(F.col("url"))),
        "redfin_details",
        keep=keep,
    )
