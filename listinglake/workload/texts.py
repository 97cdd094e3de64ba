"""Text, number, URL and list functions over whole table columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions import arrays, embedded, nulls, numbers, text, urls
from listinglake.functions.html import (
    find, find_all, html_nodes, inside, is_tag, text_of, texts_of,
)
from listinglake.workload.tables import query, table

# Trimming characters and entity decoding, as SQL.
_WS = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '||chr(160)"


def _decode(c: str) -> str:
    """The references that occur in the pages; HTML reads them without ``;`` too."""
    for name, char in (("quot", '"'), ("middot", "·"), ("copy", "©"), ("amp", "&")):
        c = f"regexp_replace({c}, '&{name};?', '{char}', 'g')"
    return c


@query(
    "parse_price_currency",
    """SELECT o_orderkey, o_totalprice AS amount,
      CASE o_orderkey % 3 WHEN 0 THEN '$' WHEN 1 THEN '€' END AS currency,
      o_totalprice AS dollars FROM orders""",
)
def price_currency(spark, sf):
    price = F.format_number("o_totalprice", 2)
    symbol = (
        F.when(F.col("o_orderkey") % 3 == 0, "$")
        .when(F.col("o_orderkey") % 3 == 1, "€ ")
        .otherwise("")
    )
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        numbers.price_and_currency(F.concat(symbol, price)).alias("p"),
        numbers.dollar_amount(F.concat(F.lit("Price: $"), price, F.lit(" /week"))).alias("dollars"),
    )
    return rows.select("o_orderkey", "p.amount", "p.currency", "dollars")


@query(
    "numbers_in_text",
    """SELECT p_partkey, p_size AS beds, CASE WHEN p_size % 7 = 0 THEN 0 ELSE p_size END AS rooms,
      CASE WHEN p_size % 5 = 0 THEN CAST(0.5 AS DOUBLE) ELSE p_retailprice END AS baths,
      CAST(p_partkey * 11 AS INTEGER) AS reviews, CAST(p_partkey AS DOUBLE) AS low,
      CAST(p_partkey * 3 AS DOUBLE) AS high, CAST(p_partkey * 7 AS INTEGER) AS sqft,
      p_retailprice AS acres, p_size AS leading, CAST(NULL AS INTEGER) AS not_leading,
      p_size AS sleeps
    FROM part""",
)
def numbers_in_text(spark, sf):
    size, key = F.col("p_size"), F.col("p_partkey")

    def s(c):
        return c.cast("string")

    r = numbers.rate_range(
        F.concat(F.lit("Weekly: $"), F.format_number(key, 0), F.lit(" - $"), F.format_number(key * 3, 0))
    )
    rooms = F.when(size % 7 == 0, F.lit("Studio")).otherwise(F.concat(s(size), F.lit(" bedrooms")))
    baths = F.when(size % 5 == 0, F.lit("Half bath")).otherwise(
        F.concat(s(F.col("p_retailprice")), F.lit(" baths"))
    )
    notes = F.array(F.lit("pool"), F.concat(F.lit("10 beds (Sleeps "), s(size), F.lit(")")))
    return table(spark, sf, "part").select(
        "p_partkey",
        numbers.beds_text(F.concat(s(size), F.lit(" beds"))).alias("beds"),
        numbers.int_from_text(rooms).alias("rooms"),
        numbers.float_from_text(baths).alias("baths"),
        numbers.review_count(F.concat(F.lit("4.9 ("), F.format_number(key * 11, 0), F.lit(")"))).alias(
            "reviews"
        ),
        r["low"].alias("low"),
        r["high"].alias("high"),
        numbers.int_with_commas(F.concat(F.lit("~"), F.format_number(key * 7, 0), F.lit(" sqft"))).alias(
            "sqft"
        ),
        numbers.float_with_commas(
            F.concat(F.format_number("p_retailprice", 1), F.lit(" acres"))
        ).alias("acres"),
        numbers.leading_int(F.concat(s(size), F.lit("+"))).alias("leading"),
        numbers.leading_int(F.concat(F.lit("BR "), s(size))).alias("not_leading"),
        numbers.sleeps_in_list(notes).alias("sleeps"),
    )


@query(
    "bath_formats",
    """SELECT p_partkey, p_size AS slash_full, p_size % 4 AS slash_half, p_size AS words_full,
      CASE WHEN p_size % 3 = 0 THEN 0 ELSE p_size % 4 END AS words_half,
      p_size AS float_full, p_size % 2 AS float_half, p_size AS text_full,
      CASE WHEN p_size % 3 = 0 THEN 0 ELSE p_size % 4 END AS text_half,
      p_size AS label_full, p_size % 4 AS label_half
    FROM part""",
)
def bath_formats(spark, sf):
    size = F.col("p_size")
    full, half = size.cast("string"), (size % 4).cast("string")
    no_half = size % 3 == 0
    kinds = {
        "slash": numbers.baths_slash(F.concat(full, F.lit("/"), half)),
        "words": numbers.baths_words(
            F.when(no_half, F.concat(full, F.lit(" Full"))).otherwise(
                F.concat(full, F.lit(" full, "), half, F.lit(" HALF"))
            )
        ),
        "float": numbers.baths_float(size + size % 2 * 0.5),
        "text": numbers.baths_text(
            F.when(no_half, F.concat(F.lit("Bathrooms: "), full)).otherwise(
                F.concat(F.lit("Bathrooms: "), full, F.lit(" & "), half, F.lit(" Half"))
            )
        ),
        "label": numbers.baths_labelled(
            F.array(
                F.lit("Full Bathrooms: 99"),
                F.concat(F.lit("Full Bathrooms: "), full),
                F.lit("Half"),
                F.concat(F.lit("Half Bathrooms "), half),
            )
        ),
    }
    columns = [v[p].alias(f"{k}_{p}") for k, v in kinds.items() for p in ("full", "half")]
    return table(spark, sf, "part").select("p_partkey", *columns)


@query(
    "strip_html",
    f"""SELECT page_id, trim(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'),
      chr(160), ' '), '&nbsp;', ' '), {_WS}) AS body FROM pages""",
)
def strip_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.strip_html(F.col("html")).alias("body"))


@query(
    "html_unescape",
    f"""SELECT page_id, {_decode("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title
    FROM pages""",
)
def html_unescape(spark, sf):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return table(spark, sf, "pages").select("page_id", text.html_unescape(title).alias("title"))


@query(
    "url_parts",
    r"""SELECT page_id, regexp_replace(url, '\?.*$', '') AS without_query,
      split_part(rtrim(url, '/'), '/', -1) AS last_part,
      'https://h/rooms/' || page_id AS room,
      'https://h/properties/' || split_part(rtrim(url, '/'), '/', -1) || '/' || page_id AS asset,
      'https://h/p/' || page_id AS absolute, url AS kept FROM pages""",
)
def url_parts(spark, sf):
    page = F.col("page_id").cast("string")
    last = text.last_segment(F.col("url"))
    return table(spark, sf, "pages").select(
        "page_id",
        text.strip_query(F.col("url")).alias("without_query"),
        last.alias("last_part"),
        urls.from_id("https://h/rooms", F.col("page_id")).alias("room"),
        urls.from_slug("https://h", last, page).alias("asset"),
        urls.absolute_path(F.concat(F.lit("/p/"), page), "https://h").alias("absolute"),
        urls.absolute_unless_http(F.col("url"), "https://h").alias("kept"),
    )


@query(
    "labels_from_names",
    """SELECT p_partkey, replace(lower(p_name), ' ', '-') AS slug,
      upper(p_name[1]) || lower(split_part(p_name, ' ', 1)[2:]) || ' '
        || upper(split_part(p_name, ' ', 2)[1]) || lower(split_part(p_name, ' ', 2)[2:]) AS area,
      p_name AS plain_name, replace(lower(p_name), ' ', '-') AS village,
      CASE WHEN p_size % 3 = 0 THEN 'For Lease' WHEN p_size % 3 = 1 THEN 'For Sale'
        ELSE 'Unknown' END AS listing_type,
      p_name AS city, 'TX' AS state, CAST(10000 + p_size AS VARCHAR) AS zip,
      CASE WHEN p_size % 2 = 0 THEN p_name || ' ' || p_brand ELSE p_name END AS address,
      trim(CASE WHEN p_size % 2 = 0 THEN p_name || ' ' || p_brand ELSE p_brand END) AS person,
      p_name || ': ' || p_brand AS beds, p_type || ', ' || p_brand AS types
    FROM part""",
)
def labels_from_names(spark, sf):
    name, brand, size = F.col("p_name"), F.col("p_brand"), F.col("p_size")
    slug = text.town_slug(name)
    even = size % 2 == 0
    kind = F.when(size % 3 == 0, "a-for-lease-b").when(size % 3 == 1, "a-for-sale-b").otherwise("a")
    place = text.address_line2(
        F.concat(F.lit(" "), name, F.lit(", TX "), (10000 + size).cast("string"))
    )
    return table(spark, sf, "part").select(
        "p_partkey",
        slug.alias("slug"),
        text.neighborhood(
            F.concat(F.lit("/outer-banks/duck/"), slug, F.lit("/rentals/x/"))
        ).alias("area"),
        text.strip_number_suffix(
            F.concat(name, F.lit(" - #"), F.col("p_partkey").cast("string"))
        ).alias("plain_name"),
        text.village_label(F.concat(F.lit("Village: "), name)).alias("village"),
        text.listing_type(kind).alias("listing_type"),
        place["city"].alias("city"),
        place["state"].alias("state"),
        place["zip"].alias("zip"),
        text.street_unit(name, F.when(even, brand).otherwise("")).alias("address"),
        text.full_name(F.when(even, name), brand).alias("person"),
        text.title_subtitle(name, brand).alias("beds"),
        text.join_list(F.array("p_type", "p_brand")).alias("types"),
    )


@query(
    "missing_value_rules",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE o_orderpriority END
        AS first_filled,
      CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS rate,
      o_orderkey % 5 = 0 AS flag, o_orderstatus = 'F' AS front,
      CASE WHEN o_orderkey % 4 = 0 THEN 'Yes' WHEN o_orderkey % 4 = 1 THEN 'No' ELSE '' END AS shown,
      CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_custkey AS INTEGER) END AS number,
      CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'none' END AS first_item,
      CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice WHEN o_orderkey % 3 = 1 THEN NULL
        ELSE CAST(o_custkey AS DOUBLE) END AS acres,
      CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE o_orderpriority END AS year,
      CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_custkey AS INTEGER) END AS sqft
    FROM orders""",
)
def missing_value_rules(spark, sf):
    key, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    cust = F.col("o_custkey").cast("string")
    even = key % 2 == 0
    keys = fv.LOT_ACRE_KEYS
    price = F.format_number("o_totalprice", 2)
    acres = F.create_map(
        F.lit(keys[0]), F.when(key % 3 == 0, price).when(key % 3 == 1, "N/A").otherwise(""),
        F.lit(keys[2]), cust,
    )
    years = F.create_map(
        F.lit("Year Built"), F.when(even, status).otherwise(""), F.lit("Year Renovated"), priority
    )
    value = F.when(key % 4 == 0, cust).otherwise("bad")
    pairs = F.array(
        F.struct(F.lit("Other").alias("key"), F.lit("1").alias("value")),
        F.struct(F.lit("SquareFootage").alias("key"), value.alias("value")),
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        nulls.first_present(F.when(even, status).otherwise(""), priority).alias("first_filled"),
        nulls.null_if_in(F.when(key % 3 == 0, "$0.00").otherwise(priority), ["$0.00", ""]).alias("rate"),
        nulls.flag_one(F.when(key % 5 == 0, "1").when(key % 5 == 1, "0")).alias("flag"),
        nulls.equals_ci(F.lower(status), "F").alias("front"),
        nulls.yes_no(F.when(key % 4 == 0, True).when(key % 4 == 1, False)).alias("shown"),
        nulls.safe_int(value).alias("number"),
        nulls.first_or(
            F.when(even, F.array(status, priority)).otherwise(F.array().cast("array<string>")),
            F.lit("none"),
        ).alias("first_item"),
        nulls.map_decimal(acres, keys).alias("acres"),
        nulls.map_first_present(years, fv.YEAR_KEYS).alias("year"),
        nulls.safe_int(nulls.keyed_value(pairs, "SquareFootage")).alias("sqft"),
    )


@query(
    "image_links",
    """SELECT p_partkey, 'https://ssl.cdn-redfin.com/photo/' || p_size || '/bigphoto/'
        || right(CAST(p_partkey + 1000 AS VARCHAR), 3) || '/' || (p_partkey + 1000) || '_0.'
        || CASE WHEN p_size % 4 <> 0 THEN 'webp' END AS photo,
      CASE WHEN p_size % 3 <> 0 THEN 'https://www.twiddy.com/property-images/' || p_partkey END
        AS image FROM part""",
)
def image_links(spark, sf):
    size = F.col("p_size")
    token = F.when(size % 3 == 0, "").otherwise(F.col("p_partkey").cast("string"))
    return table(spark, sf, "part").select(
        "p_partkey",
        urls.home_photo(
            size.cast("string"),
            (F.col("p_partkey") + 1000).cast("string"),
            F.when(size % 4 != 0, "webp"),
        ).alias("photo"),
        urls.image_from_token(token).alias("image"),
    )


# ---- embedded JSON --------------------------------------------------------------


@query(
    "embedded_json",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS in_script,
      CAST(json_extract(props, '$.k') AS INTEGER) AS after_marker,
      CASE WHEN event_type = 'click' THEN event_type END AS listed,
      CAST(json_extract(props, '$.k') AS INTEGER) AS from_cache
    FROM events""",
)
def embedded_json(spark, sf):
    """The event's JSON inside a script, behind a marker, in a list, in a cache."""
    props = F.col("props")
    page = F.concat(
        F.lit('<script>var a = "<p>{";</script><script id="data-deferred-state-0" type="j">'),
        props,
        F.lit("</script> tail }"),
    )
    marked = F.concat(F.lit("x = {}; "), F.lit(fv.REDFIN_STATE_MARKER), props, F.lit("}; root = {};"))
    listed = F.concat(
        F.lit('{"rcItemAvailForm" : [{"eid": "'), F.col("event_type"), F.lit('", "n": [1, "]"]}], "z": 2}')
    )
    entry = F.struct(F.struct(F.concat(F.lit("{}&&{\"payload\": "), props, F.lit("}")).alias("text")).alias("res"))
    cache = F.from_json(
        F.to_json(F.create_map(F.lit("first"), entry, F.lit("/a" + fv.REDFIN_SEARCH_KEY + "b"), entry)),
        "MAP<STRING, STRING>",
    )
    eid = F.get(
        F.from_json(embedded.array_after_key(listed, fv.SUNREALTY_WINDOWS), "ARRAY<STRUCT<eid: STRING>>"),
        F.lit(0),
    )["eid"]
    return table(spark, sf, "events").select(
        "event_id",
        F.from_json(embedded.script_json(page, fv.STAYS_STATE_SCRIPT), "k INT")["k"].alias("in_script"),
        F.from_json(embedded.json_after_marker(marked, fv.REDFIN_STATE_MARKER), "k INT")["k"].alias(
            "after_marker"
        ),
        F.when(eid == "click", eid).alias("listed"),
        embedded.cache_payload(cache, fv.REDFIN_SEARCH_KEY, "STRUCT<k: INT>")["k"].alias("from_cache"),
    )


@query(
    "structured_data_block",
    """SELECT doc_id, CASE WHEN text <> '' THEN text END AS description FROM documents""",
)
def structured_data_block(spark, sf):
    """Each whole document as the description in a structured-data script."""
    block = F.to_json(
        F.struct(F.array(F.lit("Product"), F.lit("RealEstateListing")).alias("@type"),
                 F.col("text").alias("description"))
    )
    page = F.concat(
        F.lit('<script type="application/ld+json">{"@type": "Organization", "description": "no"}</script>'),
        F.lit('<script type="application/ld+json">'), block, F.lit("</script>"),
    )
    return table(spark, sf, "documents").select(
        "doc_id", embedded.ld_json_description(page).alias("description")
    )


# ---- HTML -------------------------------------------------------------------------


@query(
    "html_links",
    f"""WITH links AS (
      SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>')) AS li,
        generate_subscripts(regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>'), 1) AS n
      FROM pages)
    SELECT page_id, CAST(n - 1 AS INTEGER) AS pos,
      {_decode("regexp_extract(li, 'href=\"([^\"]*)\"', 1)")} AS href,
      trim({_decode("regexp_extract(li, '>([^<]*)</a>', 1)")}) AS label
    FROM links""",
)
def html_links(spark, sf):
    """Cards of a page: the linked items of its navigation list."""
    pages = table(spark, sf, "pages").select(
        "page_id", html_nodes(F.col("html"), ["href"]).alias("nodes")
    )
    nodes = F.col("nodes")
    items = F.transform(
        find_all(nodes, lambda n: is_tag(n, "li")),
        lambda li: F.struct(
            find(inside(nodes, li), lambda n: is_tag(n, "a"))["href"].alias("href"),
            text_of(nodes, li).alias("label"),
        ),
    )
    return pages.select("page_id", F.posexplode(items).alias("pos", "item")).select(
        "page_id", "pos", "item.href", "item.label"
    )


@query(
    "html_details",
    f"""SELECT page_id,
      trim({_decode("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")}, {_WS}) AS headline,
      trim({_decode("regexp_extract(html, '<title>([^<]*)</title>', 1)")}, {_WS}) AS title,
      CAST(len(regexp_extract_all(html, '<p>|<p ')) AS INTEGER) AS paragraphs,
      nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS lang
    FROM pages""",
)
def html_details(spark, sf):
    """Single fields of a page: headings, paragraph count, an attribute."""
    pages = table(spark, sf, "pages").select(
        "page_id", html_nodes(F.col("html"), ["lang"]).alias("nodes")
    )
    nodes = F.col("nodes")

    def first_text(tag):
        return text_of(nodes, find(nodes, lambda n: is_tag(n, tag)))

    return pages.select(
        "page_id",
        first_text("h1").alias("headline"),
        first_text("title").alias("title"),
        F.size(find_all(nodes, lambda n: is_tag(n, "p"))).alias("paragraphs"),
        find(nodes, lambda n: is_tag(n, "html"))["lang"].alias("lang"),
    )


@query(
    "html_article_text",
    f"""SELECT page_id, array_to_string(list_filter(list_transform(
      string_split_regex(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]*>'),
      lambda x: trim({_decode("x")}, {_WS})), lambda x: x <> ''), ' ') AS body FROM pages""",
)
def html_article_text(spark, sf):
    """Text of every article, whole, over unclosed tags."""
    pages = table(spark, sf, "pages").select(
        "page_id", html_nodes(F.col("html"), []).alias("nodes")
    )
    nodes = F.col("nodes")
    articles = find_all(nodes, lambda n: is_tag(n, "article"))
    return pages.select(
        "page_id", F.array_join(texts_of(nodes, articles, " "), "\n").alias("body")
    )


# ---- lists -------------------------------------------------------------------------


@query(
    "ordered_distinct_union",
    """SELECT l_orderkey, l_partkey, l_linenumber, CAST(n AS INTEGER) AS pos, item FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_linenumber, l_suppkey,
        l_shipdate ORDER BY first) - 1 AS n
      FROM (
        SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_shipdate, item, min(i) AS first
        FROM (SELECT *, unnest([l_returnflag, l_linestatus, '', l_linestatus, l_returnflag, 'F', 'z'])
          AS item, unnest(range(7)) AS i FROM lineitem)
        WHERE item <> '' GROUP BY ALL))""",
)
def ordered_distinct_union(spark, sf):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    both = arrays.ordered_distinct(
        F.array(flag, status, F.lit("")), F.array(status, flag, F.lit("F"), F.lit("z"))
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.posexplode(both).alias("pos", "item")
    )


@query(
    "images_distinct_by_key",
    """SELECT page_id, CAST(n AS INTEGER) AS pos, item FROM (
      SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY first) - 1 AS n, item FROM (
        SELECT page_id, min(i) AS first, arg_min(u, i) AS item FROM (
          SELECT page_id, unnest(range(4)) AS i, unnest([url || '?a=1', '/m/' || page_id || '.jpg?w=2',
            url || '?b=2', '/m/' || page_id || '.jpg']) AS u FROM pages)
        GROUP BY page_id, regexp_replace(u, '\\?.*$', '')))""".replace("\\\\", "\\"),
)
def images_distinct_by_key(spark, sf):
    url = F.col("url")
    local = F.concat(F.lit("/m/"), F.col("page_id").cast("string"), F.lit(".jpg"))
    photos = F.array(
        F.concat(url, F.lit("?a=1")), F.concat(local, F.lit("?w=2")),
        F.concat(url, F.lit("?b=2")), local,
    )
    return table(spark, sf, "pages").select(
        "page_id", F.posexplode(arrays.distinct_by(photos, text.strip_query)).alias("pos", "item")
    )


@query(
    "keyword_line",
    """SELECT doc_id, conv_line AS line FROM (
      SELECT doc_id, list_filter(string_split(text, chr(10)),
        lambda x: contains(lower(x), 'the') AND NOT contains(lower(x), 'then'))[1] AS conv_line
      FROM documents)""",
)
def keyword_line(spark, sf):
    """First line of every document with one word and without another."""
    lines = F.split("text", "\n")
    return table(spark, sf, "documents").select(
        "doc_id", arrays.keyword_line(lines, "the", exclude="then").alias("line")
    )


@query(
    "body_block",
    """SELECT doc_id, coalesce(list_filter(string_split(text, chr(10)), lambda x: length(x) > 80)[1], '')
      AS block FROM documents""",
)
def body_block(spark, sf):
    """First block of a document long enough to be a description."""
    lines = F.split("text", "\n")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.coalesce(
            arrays.first_where(lines, lambda t: F.length(t) > fv.BODY_MIN_CHARS), F.lit("")
        ).alias("block"),
    )


@query(
    "last_wins_map",
    """SELECT c_custkey, c_mktsegment AS a, c_name AS b, CAST(2 AS INTEGER) AS n FROM customer""",
)
def last_wins_map(spark, sf):
    def pair(key, value):
        return F.struct(F.lit(key).alias("key"), value.alias("value"))

    folded = arrays.pairs_to_map(
        F.array(
            pair("a", F.col("c_name")), pair("b", F.col("c_name")), pair("a", F.col("c_mktsegment"))
        )
    )
    return table(spark, sf, "customer").select("c_custkey", folded.alias("m")).select(
        "c_custkey", F.col("m")["a"].alias("a"), F.col("m")["b"].alias("b"), F.size("m").alias("n")
    )
