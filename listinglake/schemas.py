"""Table schemas, as Spark DDL.

``RECORDS`` holds the flat records the engine produces; ``RESPONSES`` the landed
input.  A record DataFrame also carries ``page`` and ``pos`` while it is being
worked on, because row order is part of the meaning and Spark rows have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RESPONSES = """
    source STRING, kind STRING, entity_id STRING, params MAP<STRING, STRING>,
    check_in DATE, nights INT, page INT, http_status INT, fetched_at TIMESTAMP,
    body STRING
"""

WEEK_OPEN_FLAG = """STRUCT<arrive: STRING, depart: STRING, weekly_rate: DOUBLE,
    is_available: BOOLEAN, week_content: STRING>"""
WEEK_DISPLAY = """STRUCT<arrival_date: STRING, weekly_rate: STRING,
    nightly_rate: STRING, book_type: STRING>"""
WEEK_SPECIAL = """STRUCT<start_date: STRING, rate: DOUBLE, formatted_rate: STRING,
    reference_rate: DOUBLE, is_on_special: BOOLEAN>"""
WINDOW = "STRUCT<start: STRING, end: STRING, available: BOOLEAN>"

RECORDS = {
    "stays_listing": """
        listing_id STRING, url STRING, name STRING, property_type STRING,
        bedrooms INT, beds INT, bathrooms DOUBLE, latitude DOUBLE, longitude DOUBLE,
        rating DOUBLE, review_count INT, check_in STRING, check_out STRING, nights INT,
        total_price DOUBLE, price_currency STRING, price_display STRING,
        image_url STRING""",
    "stays_details": """
        listing_id STRING, url STRING, title STRING, description STRING,
        max_guests INT, sleeping_arrangements ARRAY<STRING>, location_subtitle STRING,
        latitude DOUBLE, longitude DOUBLE, host_name STRING, host_is_superhost BOOLEAN,
        host_is_verified BOOLEAN, host_about STRING, host_review_count INT,
        overall_rating DOUBLE, review_count INT,
        rating_breakdown MAP<STRING, STRING>, is_guest_favorite BOOLEAN,
        amenities ARRAY<STRING>, unavailable_amenities ARRAY<STRING>,
        highlights ARRAY<STRUCT<title: STRING, subtitle: STRING>>,
        house_rules ARRAY<STRING>, cancellation_policy STRING,
        image_urls ARRAY<STRING>""",
    "place": """
        query_key STRING, sw_lat DOUBLE, sw_lng DOUBLE, ne_lat DOUBLE, ne_lng DOUBLE,
        display_name STRING""",
    "carolinadesigns_listing": """
        listing_id STRING, url STRING, name STRING, bedrooms INT, bathrooms_full INT,
        bathrooms_half INT, town STRING, location STRING, subdivision STRING,
        image_url STRING, pet_friendly BOOLEAN, private_pool BOOLEAN""",
    "carolinadesigns_week": """
        arrival_date STRING, weekly_rate STRING, nightly_rate STRING,
        book_type STRING""",
    "carolinadesigns_details": f"""
        listing_id STRING, url STRING, name STRING, town STRING, bedrooms INT,
        bathrooms_full INT, bathrooms_half INT, sleeps INT, description STRING,
        amenities ARRAY<STRING>, image_urls ARRAY<STRING>,
        weekly_rates ARRAY<{WEEK_DISPLAY}>, min_price INT, max_price INT""",
    "churchrealty_listing": """
        listing_id STRING, url STRING, name STRING, address STRING, city STRING,
        state STRING, zip STRING, price DOUBLE, listing_type STRING,
        image_url STRING""",
    "churchrealty_details": """
        listing_id STRING, url STRING, name STRING, address STRING, city STRING,
        state STRING, zip STRING, price DOUBLE, listing_type STRING,
        description STRING, building_sqft INT, lot_acres DOUBLE, year_built INT,
        image_urls ARRAY<STRING>, agent_name STRING, agent_phone STRING""",
    "crexi_listing": """
        listing_id STRING, url STRING, name STRING, address STRING, city STRING,
        state STRING, zip STRING, price DOUBLE, property_type STRING,
        building_sqft INT, image_url STRING""",
    "crexi_details": """
        listing_id STRING, url STRING, name STRING, address STRING, city STRING,
        state STRING, zip STRING, price DOUBLE, property_type STRING,
        description STRING, building_sqft INT, lot_acres DOUBLE, year_built STRING,
        image_urls ARRAY<STRING>, broker_names ARRAY<STRING>""",
    "redfin_listing": """
        listing_id STRING, url STRING, address STRING, city STRING, state STRING,
        zip STRING, price DOUBLE, bedrooms INT, bathrooms DOUBLE, building_sqft INT,
        lot_sqft INT, year_built INT, image_url STRING""",
    "redfin_details": """
        listing_id STRING, url STRING, address STRING, city STRING, state STRING,
        zip STRING, price DOUBLE, bedrooms INT, bathrooms DOUBLE, building_sqft INT,
        lot_sqft INT, year_built INT, description STRING, image_urls ARRAY<STRING>,
        listing_agent STRING, listing_brokerage STRING, days_on_market INT,
        hoa_fee DOUBLE""",
    "sunrealty_listing": """
        listing_id STRING, url STRING, name STRING, bedrooms INT, bathrooms_full INT,
        bathrooms_half INT, sleeps INT, town STRING, community STRING,
        distance_to_beach STRING, featured_amenities ARRAY<STRING>, image_url STRING,
        check_in STRING""",
    "sunrealty_window": "start STRING, end STRING, available BOOLEAN",
    "sunrealty_details": f"""
        listing_id STRING, url STRING, name STRING, town STRING, community STRING,
        bedrooms INT, bathrooms_full INT, bathrooms_half INT, sleeps INT,
        description STRING, amenities ARRAY<STRING>, image_urls ARRAY<STRING>,
        availability_windows ARRAY<{WINDOW}>""",
    "surforsound_listing": """
        listing_id BIGINT, url STRING, name STRING, bedrooms INT, bathrooms_full INT,
        bathrooms_half INT, town STRING, location STRING, weekly_rate DOUBLE,
        check_in STRING""",
    "surforsound_details": f"""
        listing_id BIGINT, url STRING, name STRING, town STRING, bedrooms INT,
        bathrooms_full INT, bathrooms_half INT, sleeps INT, description STRING,
        amenities ARRAY<STRING>, image_urls ARRAY<STRING>, weekly_rate_min DOUBLE,
        weekly_rate_max DOUBLE, weekly_availabilities ARRAY<{WEEK_SPECIAL}>""",
    "twiddy_listing": """
        listing_id BIGINT, url STRING, name STRING, bedrooms INT, bathrooms STRING,
        town STRING, neighborhood STRING, distance_to_beach STRING, image_url STRING,
        oceanfront BOOLEAN, pet_friendly BOOLEAN, private_pool BOOLEAN, sleeps INT""",
    "twiddy_week": """
        arrive STRING, depart STRING, weekly_rate DOUBLE, is_available BOOLEAN,
        week_content STRING""",
    "twiddy_details": f"""
        listing_id BIGINT, url STRING, name STRING, town STRING, neighborhood STRING,
        bedrooms INT, bathrooms_full INT, bathrooms_half INT, sleeps INT,
        description STRING, amenities ARRAY<STRING>, image_urls ARRAY<STRING>,
        weekly_rates ARRAY<{WEEK_OPEN_FLAG}>""",
    "health": "name STRING, status STRING, summary STRING, detail ARRAY<STRING>",
}

# Lists of a details record as tables, the same for all sources.
CHILDREN = {
    "weekly_rates": """
        source STRING, listing_id STRING, pos INT, arrive DATE, depart DATE, rate DOUBLE,
        rate_display STRING, nightly_display STRING, reference_rate DOUBLE,
        is_available BOOLEAN, is_on_special BOOLEAN, book_type STRING, note STRING""",
    "availability_windows": """
        source STRING, listing_id STRING, pos INT, start DATE, end DATE,
        available BOOLEAN""",
    "amenities": """
        source STRING, listing_id STRING, pos INT, title STRING, available BOOLEAN""",
    "images": "source STRING, listing_id STRING, pos INT, url STRING",
}

ORDER_COLUMNS = ["page", "pos"]
# What a record takes along while it is made; a response that drifted is a row of these.
CARRIED = [*ORDER_COLUMNS, "entity_id", "drift"]


def record_schema(record: str) -> StructType:
    return StructType.fromDDL(RECORDS[record])


def child_fields(table: str) -> list:
    """The fields of a child table that come from a list entry."""
    return StructType.fromDDL(CHILDREN[table]).fields[3:]


def to_record(df: DataFrame, record: str, keep: list[str] | None = None) -> DataFrame:
    """Project to the declared field list and types; absent fields become null."""
    have = set(df.columns)
    fields = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in record_schema(record).fields
    ]
    names = set(record_schema(record).fieldNames())
    return df.select(*fields, *[c for c in keep or [] if c not in names])
