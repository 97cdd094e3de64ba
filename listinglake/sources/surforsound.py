"""Village search pages made of cards, and detail pages with weekly prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions import arrays, dates, ids, numbers, text, urls
from listinglake.functions.arrays import let
from listinglake.functions.html import (
    class_contains, find, find_all, has_class, html_nodes, inside, is_tag,
    label_values, markup_text, text_of, texts_of,
)
from listinglake.functions.nulls import first_present, truthy
from listinglake.schemas import CARRIED, ORDER_COLUMNS, to_record
from listinglake.sources.landing import (
    REQUEST_COLUMNS, explode_items, known, payload_table, pick, record_table, status_drift, usable_body,
)

CARD_ID = r"/property/(\d+)"
WEEKS = """ARRAY<STRUCT<startDate: STRING, rate: DOUBLE, formattedRate: STRING,
    referenceRate: DOUBLE, isOnSpecial: BOOLEAN>>"""


def stat_fields(pairs: Column) -> Column:
    """Label/value pairs of a stats block -> struct; the last of a label counts."""

    def value(label: str) -> Column:
        return arrays.last_where(pairs, lambda kv: kv["key"] == label)["value"]

    baths = numbers.baths_words(value("BATH"))
    return F.struct(
        numbers.leading_int(value("BED")).alias("bedrooms"),
        baths["full"].alias("bathrooms_full"),
        baths["half"].alias("bathrooms_half"),
        text.town_slug(value("VILLAGE")).alias("town"),
        value("LOCATION").alias("location"),
    )


def _card(nodes: Column, card: Column) -> Column:
    def first(parts: Column, tag: str, part: str) -> Column:
        return find(parts, lambda n: is_tag(n, tag) & class_contains(n, part))

    def side_village(parts: Column) -> Column:
        """Village in the line below the card body."""
        blocks = find_all(
            parts, lambda n: is_tag(n, "div") & class_contains(n, "justify-content-around")
        )
        lines = F.flatten(
            F.transform(
                blocks,
                lambda b: texts_of(
                    nodes,
                    find_all(inside(nodes, b), lambda n: is_tag(n, "small", "span", "p")),
                    " ",
                ),
            )
        )
        return text.village_label(
            arrays.first_where(lines, lambda t: t.rlike(fv.VILLAGE_LINE))
        )

    def fields(parts: Column) -> Column:
        details = first(parts, "div", "sos-property-card__details")
        pairs = label_values(nodes, details, "sos-letter-spc-1", "fw-bold")
        link = card["data_property_url"]
        return let(
            let(pairs, stat_fields),
            lambda stats: F.struct(
                text.group(link, CARD_ID).try_cast("bigint").alias("listing_id"),
                text.strip_query(link).alias("url"),
                F.coalesce(
                    text.strip_number_suffix(
                        text_of(nodes, first(parts, "div", "sos-property-card_name"))
                    ),
                    F.lit(""),
                ).alias("name"),
                stats["bedrooms"].alias("bedrooms"),
                stats["bathrooms_full"].alias("bathrooms_full"),
                stats["bathrooms_half"].alias("bathrooms_half"),
                F.coalesce(
                    first_present(stats["town"], side_village(parts)), F.lit("")
                ).alias("town"),
                stats["location"].alias("location"),
                numbers.dollar_amount(
                    text_of(nodes, first(parts, "span", "text-info"))
                ).alias("weekly_rate"),
            ),
        )

    return let(inside(nodes, card), fields)


def search_pages(responses: DataFrame) -> DataFrame:
    """Search pages with their grid counters: how many homes, how many per page."""
    df = pick(responses, fv.SURFORSOUND, "search").select(
        *REQUEST_COLUMNS,
        html_nodes(
            F.col("body"),
            ["class", "data-property-url", "total-properties-found", "page-size"],
        ).alias("nodes"),
    )
    grid = find("nodes", lambda n: n["page_size"].isNotNull())
    return df.withColumn("grid", grid).select(
        "*",
        F.when(
            F.col("grid").isNotNull(),
            F.coalesce(F.col("grid.total_properties_found").try_cast("int"), F.lit(0)),
        ).alias("total_found"),
        F.col("grid.page_size").try_cast("int").alias("page_size"),
    )


def search_payloads(responses: DataFrame) -> DataFrame:
    df = search_pages(responses)
    cards = find_all(
        F.col("nodes"), lambda n: is_tag(n, "div") & has_class(n, "sos-property-card")
    )
    any_card = F.exists(
        "nodes", lambda n: is_tag(n, "div") & class_contains(n, "sos-property-card")
    )
    return payload_table(
        df,
        status_drift(
            (~any_card & F.col("grid").isNull(), "neither cards nor a search grid")
        ),
        F.transform(cards, lambda c: _card(F.col("nodes"), c)),
    )


def listings(payloads: DataFrame, keep: list[str] = ORDER_COLUMNS) -> DataFrame:
    rows = (
        explode_items(payloads, keep)
        .filter(known("item.listing_id"))
        .select(
            *CARRIED,
            "item.*",
            F.coalesce(dates.iso(F.col("check_in")), F.lit("")).alias("check_in"),
        )
    )
    return to_record(rows, "surforsound_listing", keep=keep)


def landing_gaps(responses: DataFrame, query_keys: list[str]) -> DataFrame:
    """Queries whose landed pages are fewer than the first page announces.

    One row per query: homes found, pages expected, pages landed.
    """
    keys = [F.col("params")[k].alias(k) for k in query_keys]
    size = F.coalesce("page_size", F.lit(fv.PAGE_SIZE))
    expected = F.greatest(F.ceil(F.col("total_found") / size).cast("int"), F.lit(1))
    return (
        search_pages(responses)
        .select(*keys, "page", "total_found", expected.alias("expected"))
        .groupBy(*query_keys)
        .agg(
            F.max("total_found").alias("total_found"),
            F.coalesce(F.max("expected"), F.lit(1)).alias("pages_expected"),
            F.count_distinct("page").cast("int").alias("pages_landed"),
        )
        .withColumn("complete", F.col("pages_landed") >= F.col("pages_expected"))
    )


def week_rows(body: Column) -> Column:
    """Weekly prices in the page script; unreadable -> empty list."""
    scripts = F.regexp_extract_all(
        body, F.lit(r"(?s)<script[^>]*>(.*?)</script>"), F.lit(1)
    )
    source = arrays.first_where(scripts, lambda s: s.rlike(fv.SURFORSOUND_WEEKS))
    rows = F.transform(
        F.from_json(text.group(source, fv.SURFORSOUND_WEEKS), WEEKS),
        lambda w: F.struct(
            w["startDate"].alias("start_date"),
            w["rate"].alias("rate"),
            w["formattedRate"].alias("formatted_rate"),
            w["referenceRate"].alias("reference_rate"),
            truthy(w["isOnSpecial"]).alias("is_on_special"),
        ),
    )
    return arrays.or_empty(
        rows,
        "struct<start_date: string, rate: double, formatted_rate: string,"
        " reference_rate: double, is_on_special: boolean>",
    )


def detail_payloads(responses: DataFrame) -> DataFrame:
    df = pick(responses, fv.SURFORSOUND, "details").select(
        *REQUEST_COLUMNS,
        html_nodes(usable_body(), ["class", "id", "data-lazy"], keep_blanks=True).alias(
            "nodes"
        ),
        week_rows(usable_body()).alias("weeks"),
    )
    headed = F.exists("nodes", lambda n: is_tag(n, "h1"))
    return record_table(
        df, status_drift((~headed, "no h1")), {name: F.col(name) for name in ("nodes", "weeks")}
    )


def details(payloads: DataFrame, keep: list[str] = ORDER_COLUMNS) -> DataFrame:
    nodes = F.col("item.nodes")
    features = find(
        nodes,
        lambda n: is_tag(n, "div")
        & class_contains(n, "sos-property-card__property-features"),
    )
    amenity_box = find(nodes, lambda n: class_contains(n, "sos-column-list-3"))
    amenity_texts = texts_of(
        nodes, find_all(inside(nodes, amenity_box), lambda n: is_tag(n, "li", "p"))
    )
    photos = F.transform(
        find_all(
            nodes, lambda n: is_tag(n, "img") & n["data_lazy"].contains("/media/")
        ),
        lambda n: urls.absolute_path(n["data_lazy"], fv.SURFORSOUND_BASE),
    )
    paragraphs = texts_of(nodes, find_all(nodes, lambda n: is_tag(n, "p")))
    pairs = label_values(nodes, features, "sos-letter-spc-1", "fw-bold")
    range_line = arrays.first_where(paragraphs, lambda t: t.rlike(fv.WEEKLY_RANGE))
    df = explode_items(payloads, keep).withColumns(
        {
            "listing_id": ids.surforsound_id(F.col("entity_id")),
            "stats": let(pairs, stat_fields),
            "rates": let(range_line, numbers.rate_range),
        }
    )
    rows = df.select(
        *CARRIED,
        "listing_id",
        urls.from_id(fv.SURFORSOUND_DETAIL, F.col("listing_id")).alias("url"),
        text.strip_number_suffix(
            text_of(nodes, find(nodes, lambda n: is_tag(n, "h1")))
        ).alias("name"),
        F.coalesce(F.col("stats.town"), F.lit("")).alias("town"),
        "stats.bedrooms",
        "stats.bathrooms_full",
        "stats.bathrooms_half",
        F.coalesce(
            text.strip_html(
                markup_text(
                    nodes,
                    find(
                        nodes,
                        lambda n: is_tag(n, "div") & (n["id"] == "property-description"),
                    ),
                )
            ),
            F.lit(""),
        ).alias("description"),
        F.array_distinct(
            arrays.keep_present(
                F.filter(amenity_texts, lambda t: F.length(t) < fv.ITEM_MAX_CHARS)
            )
        ).alias("amenities"),
        arrays.distinct_by(arrays.keep_present(photos), text.strip_query).alias(
            "image_urls"
        ),
        F.col("rates.low").alias("weekly_rate_min"),
        F.col("rates.high").alias("weekly_rate_max"),
        F.col("item.weeks").alias("weekly_availabilities"),
    )
    return to_record(rows, "surforsound_details", keep=keep)
