"""Week rates, week budgets, detail joins and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions import arrays, dates, ids
from listinglake.operators import joins
from listinglake.operators import rates as rate_ops
from listinglake.operators.summary import town_funnel
from listinglake.plans import budget
from listinglake.sources.dims import places, towns
from listinglake.workload.tables import (
    OFFERS, PART_LISTINGS, RATE_ORDER, RATES, joined, offers, part_details, part_listings,
    query, rates, table,
)

TARGET = "1998-08-15"

# First rate row of the target week per listing.
_WEEK = f"""
week AS (
  SELECT * FROM rates WHERE arrive = DATE '{TARGET}'
  QUALIFY row_number() OVER (PARTITION BY listing_id
    ORDER BY l_linenumber, l_orderkey, l_suppkey, price) = 1
)"""

# Every listing with the first rate row of each of its weeks.
_WEEKS = """
weeks AS (
  SELECT * FROM rates QUALIFY row_number() OVER (PARTITION BY listing_id, arrive
    ORDER BY l_linenumber, l_orderkey, l_suppkey, price) = 1
)"""


@query(
    "week_rate_join",
    f"""WITH {RATES}, {PART_LISTINGS}, {_WEEK}
    SELECT listing_id, name, town, bedrooms, weekly_rate, is_available, book_type
    FROM listings JOIN week USING (listing_id)""",
)
def week_rate_join(spark, sf):
    first = rate_ops.first_week(
        rates(spark, sf, TARGET), F.col("arrive") == TARGET, order=RATE_ORDER
    )
    return part_listings(spark, sf).join(first, "listing_id").select(
        "listing_id", "name", "town", "bedrooms", "weekly_rate", "is_available", "book_type"
    )


@query(
    "available_week",
    f"""WITH {RATES}, {_WEEK} SELECT listing_id, weekly_rate, book_type FROM week
    WHERE is_available AND weekly_rate IS NOT NULL""",
)
def available_week(spark, sf):
    return rate_ops.available_week(
        rates(spark, sf, TARGET), TARGET, order=RATE_ORDER
    ).select("listing_id", "weekly_rate", "book_type")


@query(
    "first_week_of_each_date",
    f"""WITH {RATES}, {_WEEKS} SELECT listing_id, CAST(arrive AS VARCHAR) AS arrive,
      weekly_rate, is_available FROM weeks""",
)
def first_weeks(spark, sf):
    each = rates(spark, sf).withColumn("key", F.concat_ws("@", "listing_id", "arrive"))
    return rate_ops.first_week(each, F.col("arrive").isNotNull(), "key", RATE_ORDER).select(
        "listing_id", "arrive", "weekly_rate", "is_available"
    )


def _with_pos(df):
    """A single position column, as the budget jobs expect."""
    return df.withColumn("pos", F.struct(*RATE_ORDER))


_BUDGET = """
budget AS (
  SELECT listing_id, town, name, bedrooms, sleeps, bathrooms_full, bathrooms_half, book_type,
    {rate} AS rate, weekly_rate
  FROM listings LEFT JOIN week USING (listing_id) WHERE coalesce(bedrooms, 0) >= 7
)"""
_STRING_RATE = _BUDGET.format(rate="weekly_rate")
_FLAG_RATE = _BUDGET.format(rate="CASE WHEN is_available THEN weekly_rate END")
_FUNNEL = """
  SELECT town, count(*) AS fetched, count(rate) AS with_week,
    count(CASE WHEN rate <= 50000 THEN 1 END) AS in_budget
  FROM budget GROUP BY ROLLUP (town)"""


def _display_budget(spark, sf):
    weeks = _with_pos(rates(spark, sf, TARGET)).drop("weekly_rate").withColumnRenamed(
        "rate_display", "weekly_rate"
    )
    return budget.week_budget_display_rate(
        part_listings(spark, sf), part_details(spark, sf), weeks, TARGET, max_rate=50000
    )


@query(
    "week_budget_string_rate",
    f"""WITH {RATES}, {PART_LISTINGS}, {_WEEK}, {_STRING_RATE}
    SELECT listing_id, town, name, bedrooms, sleeps, rate, book_type FROM budget
    WHERE rate <= 50000 ORDER BY rate, listing_id""",
)
def budget_string(spark, sf):
    return _display_budget(spark, sf).in_budget.select(
        "listing_id", "town", "name", "bedrooms", "sleeps", "rate", "book_type"
    )


@query(
    "town_funnel",
    f"WITH {RATES}, {PART_LISTINGS}, {_WEEK}, {_STRING_RATE} {_FUNNEL}",
)
def funnel(spark, sf):
    return _display_budget(spark, sf).funnel


def _flag_budget(spark, sf):
    weeks = _with_pos(rates(spark, sf, TARGET)).withColumn("week_content", F.col("rate_display"))
    return budget.week_budget_open_flag(
        part_listings(spark, sf), part_details(spark, sf), weeks, TARGET, max_rate=50000
    )


@query(
    "week_budget_flag",
    f"""WITH {RATES}, {PART_LISTINGS}, {_WEEK}, {_FLAG_RATE}
    SELECT listing_id, town, name, bedrooms, bathrooms_full, bathrooms_half, rate FROM budget
    WHERE rate <= 50000 ORDER BY rate, listing_id""",
)
def budget_flag(spark, sf):
    return _flag_budget(spark, sf).in_budget.select(
        "listing_id", "town", "name", "bedrooms", "bathrooms_full", "bathrooms_half", "rate"
    )


@query(
    "town_funnel_flag",
    f"WITH {RATES}, {PART_LISTINGS}, {_WEEK}, {_FLAG_RATE} {_FUNNEL}",
)
def funnel_flag(spark, sf):
    return _flag_budget(spark, sf).funnel


@query(
    "week_budget_listing_rate",
    f"""WITH {OFFERS} SELECT listing_id, town, town AS village, bedrooms, total_price AS rate,
      page, l_orderkey FROM offers WHERE check_in = '{TARGET}' AND coalesce(bedrooms, 0) >= 7
      AND total_price <= 90000""",
)
def budget_listing(spark, sf):
    rows = offers(spark, sf).withColumnRenamed("total_price", "weekly_rate")
    found = budget.week_budget_listing_rate(rows, TARGET, max_rate=90000)
    return found.in_budget.select(
        "listing_id", "town", "village", "bedrooms", "rate", "page", "l_orderkey"
    )


@query(
    "town_funnel_all_weeks",
    f"""WITH {OFFERS} SELECT town, count(*) AS fetched, count(total_price) AS with_week,
      count(CASE WHEN total_price <= 11000 THEN 1 END) AS in_budget
    FROM offers GROUP BY ROLLUP (town)""",
)
def funnel_all(spark, sf):
    price = F.col("total_price")
    return town_funnel(
        offers(spark, sf), price.isNotNull(), price.isNotNull() & (price <= 11000)
    )


@query(
    "merge_details",
    f"""WITH {PART_LISTINGS} SELECT listing_id, name, town, bedrooms, sleeps, bathrooms_full,
      bathrooms_half FROM listings""",
)
def merge_details(spark, sf):
    columns = ["sleeps", "bathrooms_full", "bathrooms_half"]
    return joins.merge_details(
        part_listings(spark, sf), part_details(spark, sf), columns
    ).drop("url", "page", "pos")


@query(
    "three_way_combine",
    """SELECT o_orderkey, o_totalprice, first_part, lines, c_name
    FROM orders
    LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS first_part, count(*) AS lines
      FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey
    LEFT JOIN (SELECT c_custkey, c_name FROM customer) ON o_custkey = c_custkey""",
)
def three_way(spark, sf):
    lines = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_partkey").alias("first_part"), F.count("*").alias("lines"))
    )
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name"
    )
    base = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    with_lines = joins.combine_left(base, [lines], "o_orderkey")
    return joins.combine_left(with_lines, [customers], "o_custkey").drop("o_custkey")


@query(
    "left_or_empty_list",
    """SELECT p_partkey, coalesce(flags, '') AS flags, coalesce(statuses, '') AS statuses
    FROM part
    LEFT JOIN (SELECT l_partkey, string_agg(DISTINCT l_returnflag, '|' ORDER BY l_returnflag)
      AS flags FROM lineitem WHERE l_quantity > 45 GROUP BY l_partkey) f ON p_partkey = f.l_partkey
    LEFT JOIN (SELECT l_partkey, string_agg(DISTINCT l_linestatus, '|' ORDER BY l_linestatus)
      AS statuses FROM lineitem WHERE l_discount > 0.09 GROUP BY l_partkey) s
      ON p_partkey = s.l_partkey""",
)
def left_or_empty(spark, sf):
    lines = table(spark, sf, "lineitem")

    def values(test, column, name):
        # collect_set is bounded: the column has a handful of values.
        return (
            lines.filter(test)
            .groupBy(F.col("l_partkey").alias("p_partkey"))
            .agg(F.sort_array(F.collect_set(column)).alias(name))
        )

    rows = joins.left_or_empty(
        table(spark, sf, "part").select("p_partkey"),
        {
            "flags": values(F.col("l_quantity") > 45, "l_returnflag", "flags"),
            "statuses": values(F.col("l_discount") > 0.09, "l_linestatus", "statuses"),
        },
        "p_partkey",
    )
    return rows.select("p_partkey", *joined("flags", "statuses"))


_TOWN_ROWS = ", ".join(
    f"('{slug}', {i}, " + (f"'{ext}'" if ext else "CAST(NULL AS VARCHAR)") + f", '{name}')"
    for i, (slug, ext, name) in enumerate(
        (s, e, d) for src, s, e, d in fv.TOWNS if src == fv.SUNREALTY
    )
)


@query(
    "town_lookup",
    f"""WITH dim(slug, n, external_id, display_name) AS (VALUES {_TOWN_ROWS})
    SELECT c_custkey, slug AS town_slug, external_id, display_name
    FROM customer JOIN dim ON c_nationkey = n""",
)
def town_lookup(spark, sf):
    slugs = [s for src, s, _, _ in fv.TOWNS if src == fv.SUNREALTY]
    asked = F.get(F.array(*map(F.lit, slugs)), F.col("c_nationkey"))
    rows = table(spark, sf, "customer").withColumn(
        "town", F.concat(F.lit("  "), F.upper(asked))
    )
    found = joins.lookup_town(rows, fv.SUNREALTY)
    return found.select(
        "c_custkey", F.lower(F.trim("town")).alias("town_slug"), "external_id", "display_name"
    )


def _geocoder(spark, sf):
    """One geocoder response per nation; every fifth finds nothing."""
    n = F.col("n_nationkey")
    box = F.array(
        (30 + n * 0.5).cast("string"), (30.5 + n * 0.5).cast("string"),
        (-80 - n * 0.25).cast("string"), (-79.5 - n * 0.25).cast("string"),
    )
    hit = F.struct(
        box.alias("boundingbox"),
        F.when(n % 2 == 0, F.concat(F.col("n_name"), F.lit(", USA"))).alias("display_name"),
    )
    body = F.when(n % 5 == 4, "[]").otherwise(F.to_json(F.array(hit, hit)))
    return table(spark, sf, "nation").select(F.col("n_name").alias("query"), body.alias("body"))


_PLACES = """
places AS (
  SELECT lower(n_name) AS query_key, n_nationkey, 30 + n_nationkey * CAST(0.5 AS DOUBLE) AS sw_lat,
    -80 - n_nationkey * CAST(0.25 AS DOUBLE) AS sw_lng,
    30.5 + n_nationkey * CAST(0.5 AS DOUBLE) AS ne_lat,
    -79.5 - n_nationkey * CAST(0.25 AS DOUBLE) AS ne_lng,
    CASE WHEN n_nationkey % 2 = 0 THEN n_name || ', USA' ELSE n_name END AS display_name
  FROM nation WHERE n_nationkey % 5 <> 4
)"""


@query(
    "place_lookup",
    f"""WITH {_PLACES} SELECT s_suppkey, CAST(sw_lat AS DOUBLE) AS sw_lat,
      CAST(sw_lng AS DOUBLE) AS sw_lng, CAST(ne_lat AS DOUBLE) AS ne_lat,
      CAST(ne_lng AS DOUBLE) AS ne_lng, display_name
    FROM supplier JOIN nation ON s_nationkey = nation.n_nationkey
    LEFT JOIN places ON lower(n_name) = query_key""",
)
def place_lookup(spark, sf):
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    rows = table(spark, sf, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey")
    )
    asked = rows.select("s_suppkey", F.concat(F.lit(" "), F.upper("n_name")).alias("city"))
    return joins.lookup_place(asked, places(_geocoder(spark, sf))).drop("city")


@query(
    "filter_bbox",
    """WITH located AS (SELECT c_custkey, 30 + c_nationkey * CAST(0.5 AS DOUBLE) AS latitude,
      -80 + c_custkey % 40 * CAST(0.25 AS DOUBLE) AS longitude FROM customer)
    SELECT c_custkey, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude
    FROM located WHERE latitude BETWEEN 33.5 AND 37.0 AND longitude BETWEEN -78.5 AND -75.25""",
)
def bbox(spark, sf):
    from listinglake.operators.filters import filter_bbox

    rows = table(spark, sf, "customer").select(
        "c_custkey",
        (30 + F.col("c_nationkey") * 0.5).alias("latitude"),
        (-80 + F.col("c_custkey") % 40 * 0.25).alias("longitude"),
    )
    return filter_bbox(rows, 33.5, -78.5, 37.0, -75.25)


def _index(spark, sf):
    """Listing index over the pages: id, page URL, position."""
    return table(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("listing_id"),
        "url",
        F.lit(1).alias("page"),
        F.col("page_id").alias("pos"),
    )


@query(
    "resolve_identifiers",
    """WITH asked AS (
      SELECT 'id' AS how, CAST(page_id AS VARCHAR) AS identifier, lower(url) AS low, page_id, url
      FROM pages
      UNION ALL SELECT 'code', upper(regexp_extract(url, '([0-9]+[^0-9/]*/?)$', 1)),
        regexp_extract(lower(url), '([0-9]+[^0-9/]*/?)$', 1), page_id, url FROM pages
      UNION ALL SELECT 'url', url, url, page_id, url FROM pages),
    keyed AS (
      SELECT identifier, CASE WHEN trim(identifier) ~ '^[0-9]+$' THEN 'id' ELSE how END AS how2
      FROM asked WHERE identifier <> ''),
    hits AS (
      SELECT DISTINCT k.identifier, p.page_id, p.url FROM keyed k JOIN pages p ON
        (how2 = 'id' AND CAST(p.page_id AS VARCHAR) = k.identifier)
        OR (how2 = 'code' AND ends_with(lower(p.url), lower(k.identifier)))
        OR (how2 = 'url' AND p.url = k.identifier))
    SELECT identifier, CAST(page_id AS VARCHAR) AS listing_id, url FROM hits
    QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY page_id) = 1""",
)
def resolve_identifiers(spark, sf):
    """Every page asked for by id, by code (the tail of its URL) and by URL."""
    index = _index(spark, sf)
    code = F.upper(F.regexp_extract("url", "([0-9]+[^0-9/]*/?)$", 1))
    requests = (
        index.select(F.col("listing_id").alias("identifier"))
        .union(index.select(code))
        .union(index.select("url"))
        .filter(F.col("identifier") != "")
        .distinct()
    )
    return joins.resolve_identifiers(requests, index)


@query(
    "check_out_dates",
    """SELECT l_orderkey, l_partkey, l_linenumber,
      strftime(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER), '%Y-%m-%d') AS check_out,
      CAST(l_quantity AS INTEGER) AS nights,
      strftime(CAST(l_shipdate AS DATE) + 60
        + CAST(6 - dayofweek(CAST(l_shipdate AS DATE) + 60) AS INTEGER), '%Y-%m-%d') AS saturday
    FROM lineitem""",
)
def check_out_dates(spark, sf):
    line = table(spark, sf, "lineitem")
    day = F.col("l_shipdate").cast("date")
    out = dates.check_out(day, F.col("l_quantity").cast("int"))
    return line.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        dates.iso(out).alias("check_out"),
        dates.nights_between(day, out).alias("nights"),
        dates.iso(dates.saturday_after(day)).alias("saturday"),
    )


@query(
    "week_date_formats",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS from_us,
      strftime(o_orderdate, '%Y-%m-%d') AS from_timestamp FROM orders""",
)
def week_date_formats(spark, sf):
    us = F.date_format("o_orderdate", "M/d/yyyy")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.iso(dates.us_date(us)).alias("from_us"),
        dates.day_of_timestamp_text(stamp).alias("from_timestamp"),
    )


@query(
    "town_dimension",
    "SELECT count(*) AS customers, n AS c_nationkey FROM (SELECT c_nationkey AS n FROM customer) "
    "WHERE n < 15 GROUP BY n",
)
def town_dimension(spark, sf):
    """Customers per town of the fixed lookup, by position of the town."""
    slugs = towns(spark).filter(F.col("source") == fv.SUNREALTY).select("slug")
    names = [s for src, s, _, _ in fv.TOWNS if src == fv.SUNREALTY]
    slug = F.get(F.array(*map(F.lit, names)), F.col("c_nationkey"))
    counted = table(spark, sf, "customer").withColumn("slug", slug)
    return (
        counted.join(F.broadcast(slugs), "slug")
        .groupBy("c_nationkey")
        .agg(F.count("*").alias("customers"))
    )


@query(
    "identifiers_from_pages",
    r"""SELECT page_id,
      nullif(regexp_extract(url, '/([0-9]+)([^0-9/]|$)', 1), '') AS id_in_path,
      nullif(regexp_extract(url, '/([0-9]+)$', 1), '') AS id_at_end,
      CAST(nullif(regexp_extract('https://h/property/' || page_id || '?a=1', '/property/([0-9]+)', 1), '')
        AS BIGINT) AS id_in_property,
      CAST(page_id AS VARCHAR) AS home_id, CAST(page_id AS VARCHAR) AS room_id,
      url AS slug, CAST(page_id AS BIGINT) AS page_property_id, CAST(page_id AS VARCHAR) AS item_id,
      lower('SWB-' || page_id) AS code
    FROM (SELECT page_id, regexp_replace(url, '/$', '') AS url FROM pages)""",
)
def identifiers(spark, sf):
    page = F.col("page_id").cast("string")
    rows = table(spark, sf, "pages").withColumn("url", F.regexp_replace("url", "/$", ""))

    def around(left, right=""):
        return F.concat(F.lit(left), page, F.lit(right))

    return rows.select(
        "page_id",
        ids.carolinadesigns_id(F.col("url")).alias("id_in_path"),
        ids.crexi_id(F.col("url")).alias("id_at_end"),
        ids.surforsound_id(around("https://h/property/", "?a=1")).alias("id_in_property"),
        ids.redfin_id(around("/NC/Arden/x/home/")).alias("home_id"),
        ids.stays_id(around("https://h/rooms/", "?checkin=1")).alias("room_id"),
        ids.churchrealty_id(F.concat(F.lit("https://h/property/"), "url", F.lit("/"))).alias("slug"),
        ids.twiddy_page_id(F.concat(F.col("html"), around(' "propertyId":', ","))).alias(
            "page_property_id"
        ),
        ids.sunrealty_page_id(F.concat(F.col("html"), around('"item_id": "', '"'))).alias("item_id"),
        ids.sunrealty_key(around(" SWB-")).alias("code"),
    )


@query(
    "week_of_list",
    """WITH w AS (SELECT l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y-%m') AS month,
      l_extendedprice FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, month, l_extendedprice AS rate FROM w""",
)
def week_of_list(spark, sf):
    """First entry of the asked month in a list of three weeks."""
    price = F.col("l_extendedprice")
    month = F.date_format("l_shipdate", "yyyy-MM")

    def week(m, rate):
        return F.struct(m.alias("arrive"), rate.alias("rate"))

    weeks = F.array(
        week(F.lit("1900-01"), price + 1), week(month, price), week(month, price + 2)
    )
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", month.alias("month"), weeks.alias("weeks")
    )
    hit = rate_ops.week_of_list(F.col("weeks"), "arrive", F.col("month"))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "month", hit["rate"].alias("rate")
    )
