"""Index search documents, and detail pages with availability windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions import arrays, dates, ids, numbers, text
from listinglake.functions.embedded import array_after_key
from listinglake.functions.html import (
    TEXT, class_contains, find, find_all, has_class, html_nodes, inside, is_tag,
    text_of, texts_of,
)
from listinglake.functions.nulls import (
    first_or, first_present, flag_one, present, text_or_empty,
)
from listinglake.schemas import CARRIED, ORDER_COLUMNS, to_record
from listinglake.sources.landing import (
    REQUEST_COLUMNS, explode_items, known, payload_table, pick, record_table, status_drift, usable_body,
)

SEARCH = """response STRUCT<docs: ARRAY<STRUCT<
    item_id: STRING, is_eid: STRING, ss_name: STRING, ss_url: STRING,
    `is_nid$field_beds`: STRING, `fs_rc_core_lodging_product$baths`: DOUBLE,
    `is_rc_core_lodging_product$occ_total`: STRING,
    `sm_nid$rc_core_term_town$name`: ARRAY<STRING>,
    `sm_nid$rc_core_term_community$name`: ARRAY<STRING>,
    `sm_nid$rc_core_term_distance_to_beach$name`: ARRAY<STRING>,
    `sm_nid$rc_core_term_featured_amenities$name`: ARRAY<STRING>,
    sm_rc_core_item_teaser_slideshow: ARRAY<STRING>,
    ss_vrweb_default_image: STRING>>>"""

WINDOWS = "ARRAY<STRUCT<avail: ARRAY<STRUCT<b: STRING, e: STRING, a: STRING>>>>"


def search_payloads(responses: DataFrame) -> DataFrame:
    df = pick(responses, fv.SUNREALTY, "search").select(
        *REQUEST_COLUMNS, F.from_json(usable_body(), SEARCH).alias("data")
    )
    return payload_table(
        df,
        status_drift(
            (F.col("data.response").isNull(), "missing response"),
            (F.col("data.response.docs").isNull(), "missing docs"),
        ),
        F.col("data.response.docs"),
    )


def listings(payloads: DataFrame, keep: list[str] = ORDER_COLUMNS) -> DataFrame:
    item = F.col("item")
    nothing = F.lit(None).cast("string")
    baths = numbers.baths_float(item["fs_rc_core_lodging_product$baths"])
    rows = (
        explode_items(payloads, keep)
        .withColumn("listing_id", first_present(item["item_id"], item["is_eid"]))
        .filter(known("listing_id"))
        .select(
            *CARRIED,
            "listing_id",
            text_or_empty(item["ss_url"]).alias("url"),
            text_or_empty(item["ss_name"]).alias("name"),
            numbers.whole(item["is_nid$field_beds"]).alias("bedrooms"),
            baths["full"].alias("bathrooms_full"),
            baths["half"].alias("bathrooms_half"),
            numbers.whole(item["is_rc_core_lodging_product$occ_total"]).alias("sleeps"),
            first_or(item["sm_nid$rc_core_term_town$name"], F.lit("")).alias("town"),
            first_or(item["sm_nid$rc_core_term_community$name"], nothing).alias("community"),
            first_or(item["sm_nid$rc_core_term_distance_to_beach$name"], nothing).alias(
                "distance_to_beach"
            ),
            arrays.or_empty(item["sm_nid$rc_core_term_featured_amenities$name"]).alias(
                "featured_amenities"
            ),
            first_or(
                item["sm_rc_core_item_teaser_slideshow"], item["ss_vrweb_default_image"]
            ).alias("image_url"),
            F.coalesce(dates.iso(F.col("check_in")), F.lit("")).alias("check_in"),
        )
    )
    return to_record(rows, "sunrealty_listing", keep=keep)


def section_items(nodes: Column, section: Column) -> Column:
    """List items between the "Amenities" heading of a section and the next h3.

    Only blocks on the heading's own level count; the heading must be one text.
    """

    def is_heading(n: Column) -> Column:
        pieces = F.filter(inside(nodes, n), lambda t: t["tag"] == TEXT)
        return (
            is_tag(n, "h3")
            & (F.size(pieces) == 1)
            & F.get(pieces, F.lit(0))["text"].rlike("(?i)Amenities")
        )

    last = F.lit(2**31 - 1)

    def items(level: Column) -> Column:
        def up_to(stop: Column) -> Column:
            return F.filter(
                level,
                lambda n: is_tag(n, "div") & has_class(n, "item-list") & (n["i"] < stop),
            )

        next_heading = find(level, lambda n: is_tag(n, "h3"))["i"]
        return F.flatten(
            F.transform(
                arrays.let(F.coalesce(next_heading, last), up_to),
                lambda b: texts_of(
                    nodes, find_all(inside(nodes, b), lambda n: is_tag(n, "li"))
                ),
            )
        )

    def following(heading: Column) -> Column:
        """Elements behind the heading that share its parent."""

        def same_level(later: Column) -> Column:
            outside = find(later, lambda n: n["depth"] < heading["depth"])["i"]
            return arrays.let(
                F.coalesce(outside, last),
                lambda stop: F.filter(
                    later,
                    lambda n: (n["depth"] == heading["depth"])
                    & (n["tag"] != TEXT)
                    & (n["i"] < stop),
                ),
            )

        return arrays.let(
            F.filter(inside(nodes, section), lambda n: n["i"] >= heading["end"]),
            same_level,
        )

    found = arrays.let(
        find(inside(nodes, section), is_heading),
        lambda heading: arrays.let(following(heading), items),
    )
    return arrays.keep_present(found)


def windows(body: Column) -> Column:
    """Availability windows in the page script; unreadable -> empty list."""
    form = F.get(F.from_json(array_after_key(body, fv.SUNREALTY_WINDOWS), WINDOWS), F.lit(0))
    rows = F.transform(
        form["avail"],
        lambda w: F.struct(
            text_or_empty(w["b"]).alias("start"),
            text_or_empty(w["e"]).alias("end"),
            flag_one(w["a"]).alias("available"),
        ),
    )
    usable = F.filter(rows, lambda w: (w["start"] != "") & (w["end"] != ""))
    return arrays.or_empty(usable, "struct<start: string, end: string, available: boolean>")


def detail_payloads(responses: DataFrame) -> DataFrame:
    df = pick(responses, fv.SUNREALTY, "details").select(
        *REQUEST_COLUMNS,
        html_nodes(usable_body(), ["class", "src", "data-src"]).alias("nodes"),
        windows(usable_body()).alias("windows"),
        ids.sunrealty_page_id(usable_body()).alias("listing_id"),
    )
    titled = F.exists(
        "nodes", lambda n: is_tag(n, "div") & class_contains(n, "field-name-title")
    )
    return record_table(
        df,
        status_drift((~titled, "no title block")),
        {name: F.col(name) for name in ("nodes", "windows", "listing_id")},
    )


def details(payloads: DataFrame, keep: list[str] = ORDER_COLUMNS) -> DataFrame:
    nodes = F.col("item.nodes")

    def first_div(test) -> Column:
        return find(nodes, lambda n: is_tag(n, "div") & test(n))

    def field_text(name: str) -> Column:
        return text_of(nodes, first_div(lambda n: class_contains(n, name)))

    bodies = texts_of(
        nodes,
        find_all(nodes, lambda n: is_tag(n, "div") & class_contains(n, "field-name-body")),
        " ",
    )
    beds = text_of(nodes, first_div(lambda n: has_class(n, "rc-lodging-beds")))
    baths = numbers.baths_text(
        present(text_of(nodes, first_div(lambda n: has_class(n, "rc-lodging-baths"))))
    )
    photos = F.flatten(
        F.transform(
            find_all(nodes, lambda n: is_tag(n, "img")),
            lambda n: F.array(n["src"], n["data_src"]),
        )
    )
    rows = explode_items(payloads, keep).select(
        *CARRIED,
        F.col("item.listing_id").alias("listing_id"),
        F.col("entity_id").alias("url"),
        field_text("field-name-title").alias("name"),
        F.coalesce(field_text("field-name-field-town"), F.lit("")).alias("town"),
        field_text("field-name-rc-core-term-community").alias("community"),
        numbers.beds_text(beds).alias("bedrooms"),
        baths["full"].alias("bathrooms_full"),
        baths["half"].alias("bathrooms_half"),
        F.coalesce(
            arrays.first_where(bodies, lambda t: F.length(t) > fv.BODY_MIN_CHARS), F.lit("")
        ).alias("description"),
        section_items(
            nodes, first_div(lambda n: class_contains(n, "group-vr-property-amenities"))
        ).alias("amenities"),
        arrays.ordered_distinct(
            F.filter(photos, lambda u: u.contains(fv.SUNREALTY_PHOTO_HOST))
        ).alias("image_urls"),
        F.col("item.windows").alias("availability_windows"),
    )
    return to_record(rows, "sunrealty_details", keep=keep)
