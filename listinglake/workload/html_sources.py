"""Normalisers of the HTML sources over pages built from parts.

Spark writes the landed pages from the table, the normalisers read them back; the
SQL states the expected records straight from the table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.plans import search as plans
from listinglake.plans.details import find_all_details
from listinglake.plans.normalize import child_tables, detail_tables, search_tables
from listinglake.sources import surforsound
from listinglake.workload.json_sources import BEDS, _pick, _pick_sql, beds, cat, text
from listinglake.workload.tables import (
    home_list, homes_sql, joined, keyed, query, responses, table,
)

HOMES = homes_sql("part")


def blocks(make) -> Column:
    """The page parts of all homes of a row, one after the other."""
    return F.array_join(home_list(make), "\n")


# ---- churchrealty --------------------------------------------------------------------


def churchrealty_search_responses(spark, sf):
    def card(i):
        logo = '<div class="sri-listing x"><a href="/logo"><img src="https://p/logo.png"/></a></div>'
        photo = cat('<img decoding="async" src=""/><img src="https://p/', text(i), '.jpg?a=1&amp;b=2"/>')
        kind = F.when(i % 3 == 0, "for-sale").when(i % 3 == 1, "for-lease").otherwise("other")
        link = F.when(i % 13 == 0, "").otherwise(
            cat('<p class="prop_button"><a href="https://h/property/hall-', kind, "-", text(i), '/">View</a></p>')
        )
        line2 = F.when(i % 5 == 0, "Texas").otherwise(
            cat(F.col("label"), ", TX ", text(70000 + i % 9000))
        )
        return cat(
            '<div class="a property_wrap"><div class="featured_image">',
            F.when(i % 2 == 0, cat(logo, photo)).otherwise(cat(photo, logo)),
            '</div><div class="col_content"><p> ', text(i), " <b>Main</b> &amp; Oak</p>\n<p>", line2,
            "</p><p>Agent : Bob</p></div>", link, "</div>",
        )

    key = F.col("key")
    body = F.when(key % 17 == 0, "<p>No listings</p>").otherwise(
        cat("<html><body><h1>All</h1>", blocks(card), "</body></html>")
    )
    return responses(keyed(spark, sf, "part"), fv.CHURCHREALTY, "search", body, page=key)


_CHURCH = f"""
church AS (
  SELECT slug AS listing_id, 'https://h/property/' || slug || '/' AS url,
    id || 'Main& Oak' AS name, id || 'Main& Oak' AS address,
    CASE WHEN id % 5 <> 0 THEN label ELSE '' END AS city,
    CASE WHEN id % 5 <> 0 THEN 'TX' ELSE '' END AS state,
    CASE WHEN id % 5 <> 0 THEN CAST(70000 + id % 9000 AS VARCHAR) ELSE '' END AS zip,
    CAST(NULL AS DOUBLE) AS price,
    CASE id % 3 WHEN 0 THEN 'For Sale' WHEN 1 THEN 'For Lease' ELSE 'Unknown' END AS listing_type,
    'https://p/' || id || '.jpg?a=1&b=2' AS image_url, CAST(k AS INTEGER) AS page, pos
  FROM (SELECT *, 'hall-' || CASE id % 3 WHEN 0 THEN 'for-sale' WHEN 1 THEN 'for-lease' ELSE 'other' END
    || '-' || id AS slug FROM homes)
  WHERE k % 17 <> 0
)"""


@query(
    "normalize_churchrealty_search",
    # A card without link is skipped but keeps its place on the page.
    f"""WITH {HOMES}, {_CHURCH}, linked AS (SELECT * FROM church
      WHERE CAST(regexp_extract(listing_id, '([0-9]+)$', 1) AS BIGINT) % 13 <> 0)
    SELECT * FROM linked""",
)
def normalize_churchrealty_search(spark, sf):
    return search_tables(churchrealty_search_responses(spark, sf), fv.CHURCHREALTY).rows


@query(
    "quarantine_churchrealty_search",
    """SELECT 'churchrealty' AS source, 'search' AS kind, CAST(p_partkey AS INTEGER) AS page,
      'no property cards' AS drift FROM part WHERE p_partkey % 17 = 0""",
)
def quarantine_churchrealty(spark, sf):
    return search_tables(
        churchrealty_search_responses(spark, sf), fv.CHURCHREALTY
    ).quarantine.select("source", "kind", "page", "drift")


@query(
    "search_churchrealty",
    f"""WITH {HOMES}, {_CHURCH} SELECT * EXCLUDE (page, pos) FROM church
    WHERE CAST(regexp_extract(listing_id, '([0-9]+)$', 1) AS BIGINT) % 13 <> 0
      AND lower(city) LIKE '%bolt%' AND lower(state) LIKE '%tx%' AND listing_type = 'For Sale'
    ORDER BY page, pos LIMIT 50""",
)
def search_churchrealty(spark, sf):
    rows = search_tables(churchrealty_search_responses(spark, sf), fv.CHURCHREALTY).rows
    return plans.search_churchrealty(rows, "Bolt", "tx", "to buy").rows


def churchrealty_detail_responses(spark, sf):
    key, label = F.col("key"), F.col("label")

    def p(*parts):
        return cat("<p>", *parts, "</p>\n")

    lines = F.concat(
        F.when(key % 3 == 0, p("Seating: 500")).otherwise(""),
        F.when(key % 4 == 0, p("")).otherwise(""),
        p(text(key), " Charles Street"),
        F.when(key % 5 == 0, p("Zoned")).otherwise(""),
        F.when(key % 6 != 0, p(label, ", TX 77338")).otherwise(""),
        p("Land Area: ", F.format_number(key + 0.25, 2), " acres"),
        F.when(key % 7 == 0, p("Price: Please call agent")).otherwise(
            p("Price: <b>$", F.format_number(key * 1000, 0), "</b>")
        ),
        p("Building: ~", F.format_number(key * 10, 0), " sqft plus 3,000 sqft"),
        F.when(key % 8 != 0, p("Agent : ", label)).otherwise(""),
        F.when(key % 9 != 0, p("Phone: <a>", text(key), "</a> <i>ext 2</i>")).otherwise(p("Phone:")),
        p("Email: x@y"),
    )
    head = cat("<h1>Hall <i>", text(key), "</i></h1>")
    body = F.when(key % 19 == 0, cat('<div class="property_wrap">', head, "</div>")).otherwise(
        cat(
            '<html><body><div class="property_wrap">',
            F.when(key % 2 == 0, cat('<div class="property_top_area">', head, "</div>")).otherwise(head),
            '<div class="property_item_content">',
            F.when(key % 3 != 0, cat("<h3>", label, "!</h3>")).otherwise(""),
            lines,
            '</div></div><div class="property_gallery_images"><img src="https://1/',
            text(key), '"/><img src="https://2"/><img src="https://1/', text(key),
            '"/><img src=""/></div></body></html>',
        )
    )
    return responses(
        keyed(spark, sf, "part"), fv.CHURCHREALTY, "details", body,
        entity_id=cat("https://h/property/hall-for-sale-", text(key), "/"),
    )


@query(
    "normalize_churchrealty_details",
    """SELECT 'hall-for-sale-' || k AS listing_id,
      'https://www.churchrealty.com/property/hall-for-sale-' || k || '/' AS url, 'Hall' || k AS name,
      k || ' Charles Street' AS address, CASE WHEN k % 6 <> 0 THEN label ELSE '' END AS city,
      CASE WHEN k % 6 <> 0 THEN 'TX' ELSE '' END AS state,
      CASE WHEN k % 6 <> 0 THEN '77338' ELSE '' END AS zip,
      CASE WHEN k % 7 <> 0 THEN CAST(k * 1000 AS DOUBLE) END AS price, 'For Sale' AS listing_type,
      CASE WHEN k % 3 <> 0 THEN label || '!' END AS description,
      CAST(k * 10 AS INTEGER) AS building_sqft, k + CAST(0.25 AS DOUBLE) AS lot_acres,
      CAST(NULL AS INTEGER) AS year_built, 'https://1/' || k || '|https://2' AS image_urls,
      CASE WHEN k % 8 <> 0 THEN label END AS agent_name,
      CASE WHEN k % 9 <> 0 THEN k || ' ext 2' END AS agent_phone
    FROM (SELECT p_partkey AS k, p_name AS label FROM part) WHERE k % 19 <> 0""",
)
def normalize_churchrealty_details(spark, sf):
    rows = detail_tables(churchrealty_detail_responses(spark, sf), fv.CHURCHREALTY).rows
    return rows.drop("page", "pos").withColumn("image_urls", F.array_join("image_urls", "|"))


# ---- surforsound ---------------------------------------------------------------------------

_VILLAGES = [s for src, s, _, _ in fv.TOWNS if src == fv.SURFORSOUND]


def _stat(label: str, value: Column) -> Column:
    return cat(
        f'<p class="mb-0"><small><span class="small sos-letter-spc-1">{label}</span></small><br/>'
        '<span class="text-primary fw-bold"> ', value, " </span></p>\n",
    )


def surforsound_search_responses(spark, sf):
    key = F.col("key")
    village = F.initcap(_pick(_VILLAGES, key % 7))

    def card(i):
        stats = F.concat(
            F.when(i % 11 != 0, _stat("Bed", text(beds(i)))).otherwise(""),
            F.when(i % 4 != 0, _stat("Bath", cat(text(i % 9), " Full, ", text(i % 3), " Half"))).otherwise(""),
            F.when(i % 5 != 0, _stat("Location", F.col("label"))).otherwise(""),
            F.when(i % 2 == 0, _stat("Village", village)).otherwise(""),
        )
        link = F.when(i % 13 == 0, "/none").otherwise(
            cat("https://h/r/property/", text(i), "?Checkin=2026&amp;x=1")
        )
        return cat(
            '<div class="sos-property-card small" data-property-url="', link, '">',
            '<div class="lead sos-property-card_name x">\n', F.col("label"), " - #", text(i), "\n</div>",
            '<div class="sos-property-card__details w">', stats,
            '<div><span class="text-info fw-bold">',
            F.when(i % 10 == 5, "Call").otherwise(cat("$", F.format_number(i % 9000 + 100, 0), " /week")),
            '</span></div></div><div class="d-flex justify-content-around"><small>Saturday Check in</small>',
            "<small>Village: ", village, "</small></div></div>",
        )

    cards = blocks(card)
    body = (
        F.when(key % 23 == 0, "<p>Nothing here</p>")
        .when(key % 3 == 0, cards)
        .otherwise(
            cat(
                '<html><body><div class="sos-search-results-grid" total-properties-found="',
                text(key % 60), '" page-size="24">', cards, "</div></body></html>",
            )
        )
    )
    return responses(
        keyed(spark, sf, "part"), fv.SURFORSOUND, "search", body, page=key + 1,
        params={"villages": _pick(_VILLAGES, key % 7)},
        check_in=F.when(key % 2 == 0, F.lit("2026-08-15")),
        entity_id=text(key),
    )


_SOS = f"""
sos AS (
  SELECT id AS listing_id, 'https://h/r/property/' || id AS url, label AS name, {BEDS} AS bedrooms,
    CASE WHEN id % 4 <> 0 THEN CAST(id % 9 AS INTEGER) END AS bathrooms_full,
    CASE WHEN id % 4 <> 0 THEN CAST(id % 3 AS INTEGER) END AS bathrooms_half,
    {_pick_sql(_VILLAGES, "k % 7")} AS town, CASE WHEN id % 5 <> 0 THEN label END AS location,
    CASE WHEN id % 10 <> 5 THEN CAST(id % 9000 + 100 AS DOUBLE) END AS weekly_rate,
    CASE WHEN k % 2 = 0 THEN '2026-08-15' ELSE '' END AS check_in,
    CAST(k + 1 AS INTEGER) AS page, pos
  FROM homes WHERE k % 23 <> 0 AND id % 13 <> 0
)"""


@query("normalize_surforsound_search", f"WITH {HOMES}, {_SOS} SELECT * FROM sos")
def normalize_surforsound_search(spark, sf):
    return search_tables(surforsound_search_responses(spark, sf), fv.SURFORSOUND).rows


@query(
    "search_surforsound",
    f"""WITH {HOMES}, {_SOS} SELECT * EXCLUDE (page, pos) FROM sos
    WHERE town = 'avon' AND check_in = '2026-08-15' AND coalesce(bedrooms, 0) >= 4
    ORDER BY page, pos LIMIT 50""",
)
def search_surforsound(spark, sf):
    rows = search_tables(surforsound_search_responses(spark, sf), fv.SURFORSOUND).rows
    return plans.search_surforsound(rows, "Avon", 4, 50, "2026-08-15").rows


@query(
    "landing_gaps",
    f"""WITH pages_ AS (
      SELECT {_pick_sql(_VILLAGES, "k % 7")} AS villages, CAST(k + 1 AS INTEGER) AS page,
        CASE WHEN k % 3 <> 0 AND k % 23 <> 0 THEN CAST(k % 60 AS INTEGER) END AS found
      FROM (SELECT p_partkey AS k FROM part))
    SELECT villages, max(found) AS total_found,
      coalesce(max(greatest(CAST(ceil(found / 24.0) AS INTEGER), 1)), 1) AS pages_expected,
      CAST(count(DISTINCT page) AS INTEGER) AS pages_landed,
      count(DISTINCT page) >= coalesce(max(greatest(CAST(ceil(found / 24.0) AS INTEGER), 1)), 1)
        AS complete
    FROM pages_ GROUP BY villages""",
)
def landing_gaps(spark, sf):
    return surforsound.landing_gaps(surforsound_search_responses(spark, sf), ["villages"])


def surforsound_detail_responses(spark, sf):
    key, label = F.col("key"), F.col("label")
    week = F.transform(
        F.sequence(F.lit(0), (key % 3).cast("int")),
        lambda n: F.struct(
            cat("2026-07-", F.lpad(text(n * 7 + 4), 2, "0")).alias("startDate"),
            F.when(n != 2, (key % 9000 + n).cast("double")).alias("rate"),
            cat("$", text(key)).alias("formattedRate"),
            (n == 1).alias("isOnSpecial"),
        ),
    )
    features = cat(
        '<div class="sos-property-card__property-features">', _stat("VILLAGE", F.lit("Kitty Hawk")),
        F.when(key % 11 != 0, _stat("BED", text(beds(key)))).otherwise(""),
        _stat("BATH", cat(text(key % 9), " Full, ", text(key % 3), " Half")), "</div>",
    )
    body = F.when(key % 29 == 0, "<p>No heading</p>").otherwise(
        cat(
            "<html><body><script>window.a = [1];</script><script>Sos.WeeklyAvailabilities = ",
            F.when(key % 7 == 0, "[{bad}]").otherwise(F.to_json(week)), ";\n</script><h1>", label,
            " - #", text(key), "</h1>", features,
            '<div id="property-description"><p>A <b>', label, "</b> home &amp; more.</p>\n</div>",
            '<ul class="sos-column-list-3"><li>Pool</li><li>', label, "</li><li>Pool</li><li>",
            "x" * 200, "</li></ul><p>intro</p><p>Weekly: $", F.format_number(key, 0), " - $",
            F.format_number(key * 3, 0), '</p><img data-lazy="/media/', text(key),
            '.jpg?w=1"/><img data-lazy="/media/', text(key),
            '.jpg?w=2"/><img data-lazy="https://x/media/2.jpg"/><img data-lazy="/other/3.jpg"/>',
            '<h2>You may also like</h2><div class="sos-property-card__property-features">',
            _stat("BED", F.lit("99")), "</div></body></html>",
        )
    )
    return responses(
        keyed(spark, sf, "part"), fv.SURFORSOUND, "details", body,
        entity_id=cat("/hatteras-vacation-rental/property/", text(key), "?x=1"),
    )


def _surforsound_details(spark, sf):
    return detail_tables(surforsound_detail_responses(spark, sf), fv.SURFORSOUND).rows


@query(
    "normalize_surforsound_details",
    """SELECT k AS listing_id, 'https://www.surforsound.com/hatteras-vacation-rental/property/' || k AS url,
      label AS name, 'kitty-hawk' AS town,
      CASE WHEN k % 11 <> 0 THEN CAST(k % 12 AS INTEGER) END AS bedrooms,
      CAST(k % 9 AS INTEGER) AS bathrooms_full, CAST(k % 3 AS INTEGER) AS bathrooms_half,
      CAST(NULL AS INTEGER) AS sleeps, 'A  ' || label || '  home &amp; more.' AS description,
      'Pool|' || label AS amenities,
      'https://www.surforsound.com/media/' || k || '.jpg?w=1|https://x/media/2.jpg' AS image_urls,
      CAST(k AS DOUBLE) AS weekly_rate_min, CAST(k * 3 AS DOUBLE) AS weekly_rate_max,
      CAST(CASE WHEN k % 7 = 0 THEN 0 ELSE k % 3 + 1 END AS INTEGER) AS weeks
    FROM (SELECT p_partkey AS k, p_name AS label FROM part) WHERE k % 29 <> 0""",
)
def normalize_surforsound_details(spark, sf):
    rows = _surforsound_details(spark, sf)
    plain = [
        c for c in rows.columns
        if c not in ("amenities", "image_urls", "weekly_availabilities", "page", "pos")
    ]
    return rows.select(
        *plain, *joined("amenities", "image_urls"), F.size("weekly_availabilities").alias("weeks")
    )


@query(
    "weekly_rates_special",
    """SELECT k AS listing_id, CAST(n AS INTEGER) AS pos,
      '2026-07-' || lpad(CAST(n * 7 + 4 AS VARCHAR), 2, '0') AS start_date,
      CASE WHEN n <> 2 THEN CAST(k % 9000 + n AS DOUBLE) END AS rate, '$' || k AS formatted_rate,
      CAST(NULL AS DOUBLE) AS reference_rate, n = 1 AS is_on_special
    FROM (SELECT p_partkey AS k FROM part), (SELECT unnest(range(3)) AS n)
    WHERE n <= k % 3 AND k % 29 <> 0 AND k % 7 <> 0""",
)
def weekly_rates_special(spark, sf):
    return child_tables(_surforsound_details(spark, sf), fv.SURFORSOUND)["weekly_availabilities"]


# ---- sunrealty details ------------------------------------------------------------------------


def sunrealty_detail_responses(spark, sf):
    key, label = F.col("key"), F.col("label")
    long = "A long description of a home by the sea, with every extra that a family could ask for: "
    windows = F.transform(
        F.sequence(F.lit(0), (key % 4).cast("int")),
        lambda n: F.struct(
            cat("2026-05-0", text(n + 1)).alias("b"),
            F.when(n != 2, cat("2026-06-0", text(n + 1))).otherwise("").alias("e"),
            F.when(n % 2 == 0, "1").otherwise("0").alias("a"),
        ),
    )
    form = F.to_json(F.array(F.struct(text(key).alias("eid"), windows.alias("avail"))))
    script = F.when(key % 7 == 0, cat('{"item_id": "', text(key), '"}')).otherwise(
        cat('{"rcItemAvailForm" : ', form, ', "z": ["]"]}')
    )
    items = cat("<div class='item-list'><ul><li>", label, "</li><li> </li><li>Pool <b>deck</b></li></ul></div>")
    section = cat(
        "<h3>Rooms</h3><div class='item-list'><li>no</li></div><h3>Amenities &amp; Beds</h3>", items,
        "<div class='other'><li>no</li></div><div class='x item-list'><li>Spa</li></div>",
        F.when(key % 2 == 0, "<h3>More</h3><div class='item-list'><li>late</li></div>").otherwise(""),
    )
    body = F.when(key % 31 == 0, "<p>gone</p>").otherwise(
        cat(
            "<html><body><h1>Site</h1><div class='field field-name-title'>", label, " <i>X</i></div>",
            "<div class='rc-lodging-beds y'>Bedrooms: ", text(key % 12), "</div>",
            F.when(key % 3 != 0, cat("<div class='rc-lodging-baths'>Bathrooms: ", text(key % 9), " &amp; 1 Half</div>")).otherwise(""),
            F.when(key % 4 != 0, cat("<div class='a field-name-field-town'>", label, "</div>")).otherwise(""),
            F.when(key % 5 != 0, cat("<div class='field-name-rc-core-term-community'>", F.col("kind_text"), "</div>")).otherwise(""),
            "<div class='field-name-body'>short</div><div class='field-name-body'><p>", long, "</p><p> ", label, "</p></div>",
            "<div class='group-vr-property-amenities z'>", section, "</div>",
            "<img src='https://i.rezfusion.com/", text(key), "' data-src='https://i.rezfusion.com/z'/>",
            "<img src='https://other/3'/><img data-src='https://i.rezfusion.com/z'/>",
            "<script>extend(", script, ");</script></body></html>",
        )
    )
    return responses(
        keyed(spark, sf, "part"), fv.SUNREALTY, "details", body, entity_id=cat("https://h/", text(key))
    )


def _sunrealty_details(spark, sf):
    return detail_tables(sunrealty_detail_responses(spark, sf), fv.SUNREALTY).rows


@query(
    "normalize_sunrealty_details",
    """SELECT CAST(k AS VARCHAR) AS listing_id, 'https://h/' || k AS url, label || 'X' AS name,
      CASE WHEN k % 4 <> 0 THEN label ELSE '' END AS town, CASE WHEN k % 5 <> 0 THEN kind END AS community,
      CAST(k % 12 AS INTEGER) AS bedrooms, CASE WHEN k % 3 <> 0 THEN CAST(k % 9 AS INTEGER) END AS bathrooms_full,
      CASE WHEN k % 3 <> 0 THEN 1 END AS bathrooms_half, CAST(NULL AS INTEGER) AS sleeps,
      'A long description of a home by the sea, with every extra that a family could ask for: ' || label
        AS description,
      label || '|Pooldeck|Spa' AS amenities,
      'https://i.rezfusion.com/' || k || '|https://i.rezfusion.com/z' AS image_urls
    FROM (SELECT p_partkey AS k, p_name AS label, p_type AS kind FROM part) WHERE k % 31 <> 0""",
)
def normalize_sunrealty_details(spark, sf):
    rows = _sunrealty_details(spark, sf)
    plain = [
        c for c in rows.columns
        if c not in ("amenities", "image_urls", "availability_windows", "page", "pos")
    ]
    return rows.select(*plain, *joined("amenities", "image_urls"))


@query(
    "explode_windows",
    """SELECT CAST(k AS VARCHAR) AS listing_id,
      CAST(CASE WHEN n = 3 THEN 2 ELSE n END AS INTEGER) AS pos, '2026-05-0' || (n + 1) AS start,
      '2026-06-0' || (n + 1) AS "end", n % 2 = 0 AS available
    FROM (SELECT p_partkey AS k FROM part), (SELECT unnest(range(4)) AS n)
    WHERE n <= k % 4 AND n <> 2 AND k % 31 <> 0 AND k % 7 <> 0""",
)
def explode_windows(spark, sf):
    return child_tables(_sunrealty_details(spark, sf), fv.SUNREALTY)["availability_windows"]


@query(
    "section_items",
    """SELECT CAST(k AS VARCHAR) AS listing_id, CAST(n AS INTEGER) AS pos,
      CASE n WHEN 0 THEN label WHEN 1 THEN 'Pooldeck' ELSE 'Spa' END AS value
    FROM (SELECT p_partkey AS k, p_name AS label FROM part), (SELECT unnest(range(3)) AS n)
    WHERE k % 31 <> 0""",
)
def section_items(spark, sf):
    return child_tables(_sunrealty_details(spark, sf), fv.SUNREALTY)["amenities"]


# ---- details by any name --------------------------------------------------------------------


@query(
    "details_by_url_id_or_code",
    """SELECT CASE k % 3 WHEN 0 THEN ' https://h/' || k || '/' WHEN 1 THEN CAST(k AS VARCHAR)
        ELSE 'H/' || k END AS identifier,
      CASE k % 3 WHEN 0 THEN 'url' WHEN 1 THEN 'id' ELSE 'index' END AS found_by,
      CAST(k AS VARCHAR) AS listing_id, 'https://h/' || k AS url, label || 'X' AS name
    FROM (SELECT p_partkey AS k, p_name AS label FROM part) WHERE k % 31 <> 0""",
)
def details_by_url_id_or_code(spark, sf):
    """No index of search rows: URLs stand for themselves, codes end the details' URLs."""
    key = F.col("p_partkey")
    requests = table(spark, sf, "part").select(
        F.when(key % 3 == 0, cat(" https://h/", text(key), "/"))
        .when(key % 3 == 1, text(key))
        .otherwise(cat("H/", text(key)))
        .alias("identifier")
    )
    found = find_all_details(requests, _sunrealty_details(spark, sf), fv.SUNREALTY)
    return found.select("identifier", "found_by", "listing_id", "url", "name")
