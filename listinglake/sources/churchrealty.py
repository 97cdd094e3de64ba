"""One index page of cards, and detail pages of labelled paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions import arrays, ids, numbers, text, urls
from listinglake.functions.arrays import let
from listinglake.functions.html import (
    find, find_all, has_class, html_nodes, inside, is_tag, text_of, texts_of,
)
from listinglake.functions.nulls import present
from listinglake.schemas import CARRIED, ORDER_COLUMNS, to_record
from listinglake.sources.landing import (
    REQUEST_COLUMNS, explode_items, known, payload_table, pick, record_table, status_drift, usable_body,
)

# Paragraph labels that are known but carry no field.
UNUSED_LABELS = ("seating:", "parking:")


def _box(nodes: Column, name: str) -> Column:
    return find(nodes, lambda n: is_tag(n, "div") & has_class(n, name))


def card_image(nodes: Column, card: Column) -> Column:
    """First image of the photo block that is not inside its logo block."""
    def first_outside(photo: Column) -> Column:
        return let(
            _box(photo, "sri-listing"),
            lambda logo: find(
                photo,
                lambda n: is_tag(n, "img")
                & present(n["src"]).isNotNull()
                & ~F.coalesce(
                    (n["i"] > logo["i"]) & (n["i"] < logo["end"]), F.lit(False)
                ),
            ),
        )

    photo = inside(nodes, _box(inside(nodes, card), "featured_image"))
    return let(photo, first_outside)["src"]


def _card(nodes: Column, card: Column) -> Column:
    def fields(link: Column, lines: Column) -> Column:
        street = F.coalesce(F.get(lines, F.lit(0)), F.lit(""))
        slug = text.last_segment(link)
        place = text.address_line2(F.get(lines, F.lit(1)))
        return F.struct(
            slug.alias("listing_id"),
            F.concat(F.rtrim(link, F.lit("/")), F.lit("/")).alias("url"),
            street.alias("name"),
            street.alias("address"),
            place["city"].alias("city"),
            place["state"].alias("state"),
            place["zip"].alias("zip"),
            text.listing_type(slug).alias("listing_type"),
            card_image(nodes, card).alias("image_url"),
        )

    def read(parts: Column) -> Column:
        link = find(parts, lambda n: is_tag(n, "a") & n["href"].contains("/property/"))
        paragraphs = find_all(
            inside(nodes, _box(parts, "col_content")), lambda n: is_tag(n, "p")
        )
        return let(
            F.struct(
                link["href"].alias("link"), texts_of(nodes, paragraphs).alias("lines")
            ),
            lambda x: fields(x["link"], x["lines"]),
        )

    return let(inside(nodes, card), read)


def search_payloads(responses: DataFrame) -> DataFrame:
    df = (
        pick(responses, fv.CHURCHREALTY, "search")
        .select(
            *REQUEST_COLUMNS,
            html_nodes(usable_body(), ["class", "href", "src"]).alias("nodes"),
        )
        .withColumn(
            "cards",
            find_all("nodes", lambda n: is_tag(n, "div") & has_class(n, "property_wrap")),
        )
    )
    return payload_table(
        df,
        status_drift((F.size("cards") == 0, "no property cards")),
        F.transform("cards", lambda c: _card(F.col("nodes"), c)),
    )


def listings(payloads: DataFrame, keep: list[str] = ORDER_COLUMNS) -> DataFrame:
    rows = (
        explode_items(payloads, keep)
        .filter(known("item.listing_id"))
        .select(*CARRIED, "item.*")
    )
    return to_record(rows, "churchrealty_listing", keep=keep)


def detail_payloads(responses: DataFrame) -> DataFrame:
    df = (
        pick(responses, fv.CHURCHREALTY, "details")
        .select(
            *REQUEST_COLUMNS,
            html_nodes(usable_body(), ["class", "src"]).alias("nodes"),
        )
        .withColumn("wrap", _box(F.col("nodes"), "property_wrap"))
        .withColumn("content", _box(inside(F.col("nodes"), F.col("wrap")), "property_item_content"))
    )
    return record_table(
        df,
        status_drift(
            (F.col("wrap").isNull(), "no property block"),
            (F.col("content").isNull(), "no property content"),
        ),
        {name: F.col(name) for name in ("nodes", "wrap", "content")},
    )


def paragraph_fields(nodes: Column, content: Column) -> Column:
    """Route the paragraphs of a detail page to fields.

    A labelled paragraph fills its field, the last one of a label counting.  Of
    the others, the first non-empty one is the street and the first later one
    that reads "City, ST 12345" is the city line.
    """
    marks = find_all(inside(nodes, content), lambda n: is_tag(n, "p"))
    lines = F.transform(
        marks,
        lambda p: let(
            text_of(nodes, p),
            lambda t: F.struct(
                t.alias("text"),
                F.lower(t).alias("low"),
                text_of(nodes, p, " ").alias("spaced"),
            ),
        ),
    )

    def route(ls: Column) -> Column:
        def last(label: str) -> Column:
            return arrays.last_where(ls, lambda p: p["low"].startswith(label))

        def unlabelled(p: Column) -> Column:
            labels = ("price:", "building:", "land area:", "agent", "phone", *UNUSED_LABELS)
            known = F.lit(False)
            for label in labels:
                known = known | p["low"].startswith(label)
            return ~known & (p["text"] != "")

        def address(rest: Column) -> Column:
            after_street = F.filter(rest, lambda p, i: i > 0)
            city_line = arrays.first_where(
                after_street, lambda p: p["text"].rlike(fv.CITY_STATE_ZIP)
            )["text"]
            return F.struct(
                F.coalesce(F.get(rest, F.lit(0))["text"], F.lit("")).alias("street"),
                text.address_line2(city_line).alias("place"),
            )

        return F.struct(
            numbers.dollar_amount(last("price:")["text"]).alias("price"),
            numbers.int_with_commas(
                text.drop_label(last("building:")["text"], "building:")
            ).alias("building_sqft"),
            numbers.float_with_commas(
                text.drop_label(last("land area:")["text"], "land area:")
            ).alias("lot_acres"),
            text.strip(
                text.drop_label(last("agent")["text"], r"agent\s*:")
            ).alias("agent_name"),
            present(
                text.strip(text.drop_label(last("phone")["spaced"], "phone:?"))
            ).alias("agent_phone"),
            let(F.filter(ls, unlabelled), address).alias("address"),
        )

    return let(lines, route)


def details(payloads: DataFrame, keep: list[str] = ORDER_COLUMNS) -> DataFrame:
    nodes, content = F.col("item.nodes"), F.col("item.content")
    wrapped = inside(nodes, F.col("item.wrap"))
    top = _box(wrapped, "property_top_area")
    headline = find(
        F.when(top.isNotNull(), inside(nodes, top)).otherwise(wrapped),
        lambda n: is_tag(n, "h1"),
    )
    gallery = inside(nodes, _box(nodes, "property_gallery_images"))
    df = (
        explode_items(payloads, keep)
        .withColumn("listing_id", ids.churchrealty_id(F.col("entity_id")))
        .withColumn("fields", paragraph_fields(nodes, content))
    )
    rows = df.select(
        *CARRIED,
        "listing_id",
        urls.from_id(fv.CHURCHREALTY_BASE + "/property", F.col("listing_id"), "/").alias(
            "url"
        ),
        F.coalesce(text_of(nodes, headline), F.lit("")).alias("name"),
        F.col("fields.address.street").alias("address"),
        F.col("fields.address.place.city").alias("city"),
        F.col("fields.address.place.state").alias("state"),
        F.col("fields.address.place.zip").alias("zip"),
        "fields.price",
        text.listing_type(F.col("listing_id")).alias("listing_type"),
        text_of(
            nodes, find(inside(nodes, content), lambda n: is_tag(n, "h3"))
        ).alias("description"),
        "fields.building_sqft",
        "fields.lot_acres",
        arrays.ordered_distinct(
            F.transform(find_all(gallery, lambda n: is_tag(n, "img")), lambda n: n["src"])
        ).alias("image_urls"),
        "fields.agent_name",
        "fields.agent_phone",
    )
    return to_record(rows, "churchrealty_details", keep=keep)
