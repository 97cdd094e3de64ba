"""Health, completeness and report tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.operators import summary
from listinglake.operators.topk import with_rank
from listinglake.plans import budget, health, report
from listinglake.plans.normalize import search_tables
from listinglake.session import checkpoint_dir
from listinglake.sources.sinks import write_report
from listinglake.workload.json_sources import carolinadesigns_search_responses
from listinglake.workload.rates import TARGET
from listinglake.workload.tables import (
    OFFERS, PART_LISTINGS, RATE_ORDER, RATES, SQL, offers, part_details, part_listings, query, rates,
    table,
)


def _health(spark, sf):
    """Sources in different states: good, empty, incomplete, drifted."""
    parts = part_listings(spark, sf)
    homes = parts.withColumns(
        {
            "total_price": F.col("pos").cast("double"),
            "title": F.col("name"),
            "city": F.lit(""),
            "state": F.lit("TX"),
            "address": F.col("name"),
            "price": F.col("pos").cast("double"),
            "bathrooms_full": F.lit(1),
            "listing_type": F.lit(None).cast("string"),
        }
    ).withColumn("bedrooms", F.lit(0))
    searches = {
        fv.STAYS: homes,
        fv.CAROLINADESIGNS: homes,
        fv.CHURCHREALTY: homes,
        fv.CREXI: homes.withColumn("city", F.lit("Atlanta")),
        fv.REDFIN: homes,
        # No part is that large, so this source finds nothing.
        fv.SUNREALTY: homes.filter(F.col("bedrooms") > F.length("name") + 1000),
        fv.SURFORSOUND: homes,
        fv.TWIDDY: homes,
    }
    details = {
        **searches,
        fv.SURFORSOUND: homes.withColumn("bedrooms", F.lit(None).cast("int")),
        fv.TWIDDY: homes.filter(F.col("pos") > 0),
    }
    drifted = search_tables(carolinadesigns_search_responses(spark, sf), fv.CAROLINADESIGNS)
    return health.health_report(searches, details, drifted.quarantine)


_STATUS = """
health AS (
  SELECT name, status, replace(summary, '#', CAST(n AS VARCHAR)) AS summary
  FROM (SELECT count(*) AS n FROM part), (VALUES
    ('stays', 'PASS', 'search + details OK (# results, all required fields populated)'),
    ('carolinadesigns', 'FAIL', 'search failed: missing Results'),
    ('churchrealty', 'FAIL', 'search result missing required fields: [''city'', ''listing_type'']'),
    ('crexi', 'PASS', 'search + details OK (# results, all required fields populated)'),
    ('redfin', 'FAIL', 'search result missing required fields: [''city'']'),
    ('sunrealty', 'WARN', 'search returned 0 results — could be drift OR genuinely empty'),
    ('surforsound', 'FAIL', 'details missing required fields: [''bedrooms'']'),
    ('twiddy', 'FAIL', 'details failed: no detail row')) AS v(name, status, summary)
)"""


@query("health_report", f"WITH {_STATUS} SELECT * FROM health")
def health_report(spark, sf):
    return _health(spark, sf).select("name", "status", "summary")


@query(
    "status_tally",
    f"""WITH {_STATUS} SELECT count(*) FILTER (status = 'PASS') AS pass,
      count(*) FILTER (status = 'WARN') AS warn, count(*) FILTER (status = 'FAIL') AS fail FROM health""",
)
def status_tally(spark, sf):
    return summary.status_tally(_health(spark, sf))


@query(
    "missing_fields",
    f"""WITH {OFFERS} SELECT listing_id, page, l_orderkey, total, check_in,
      concat_ws('|', CASE WHEN bedrooms IS NULL THEN 'bedrooms' END,
        CASE WHEN total_price IS NULL THEN 'total_price' END,
        CASE WHEN rating IS NULL THEN 'rating' END) AS missing
    FROM offers""",
)
def missing_fields(spark, sf):
    rows = offers(spark, sf)
    fields = ["name", "bedrooms", "total_price", "rating"]
    return rows.select(
        "listing_id", "page", "l_orderkey", "total", "check_in",
        F.array_join(summary.missing_fields(rows, fields), "|").alias("missing"),
    )


@query(
    "field_population",
    f"""WITH {OFFERS} SELECT count(*) AS rows, count(name) AS name_filled,
      count(bedrooms) AS bedrooms_filled, count(total_price) AS total_price_filled,
      count(rating) AS rating_filled FROM offers""",
)
def field_population(spark, sf):
    return summary.population(offers(spark, sf), ["name", "bedrooms", "total_price", "rating"])


_RULE = f"""
ruled AS (
  SELECT * FROM offers WHERE bedrooms >= 7 AND nights = 7 AND total_price <= 11000
    AND coalesce(rating, 4.0) >= 4.0
  QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY total_price, check_in, page,
    l_orderkey, l_suppkey, total, nights) = 1
)"""
_STAYS_COLUMNS = """name AS "Listing", town AS "Town", total_price AS "7-Night Total",
  bedrooms AS "BR", CAST(NULL AS INTEGER) AS "Beds", bathrooms AS "Baths", rating AS "Rating",
  coalesce(review_count, 0) AS "Reviews", check_in AS "Check-in", '' AS "Why", url AS "URL" """


def _stays_report(spark, sf):
    rows = offers(spark, sf).withColumn("beds", F.lit(None).cast("int"))
    order = ["check_in", "page", "l_orderkey", "l_suppkey", "total", "nights"]
    return report.stays_report(rows, order, top_n=12, honorable_n=4, min_reviews=20)


@query(
    "report_top_picks",
    f"""WITH {OFFERS}, {_RULE} SELECT CAST(row_number() OVER (ORDER BY total_price, listing_id)
      AS INTEGER) AS "Rank", {_STAYS_COLUMNS} FROM ruled WHERE coalesce(review_count, 0) >= 20
    ORDER BY total_price, listing_id LIMIT 12""",
)
def report_top_picks(spark, sf):
    return _stays_report(spark, sf)["top_picks"]


@query(
    "report_honorable_mentions",
    f"""WITH {OFFERS}, {_RULE} SELECT CAST(NULL AS INTEGER) AS "Rank", {_STAYS_COLUMNS}
    FROM ruled WHERE coalesce(review_count, 0) < 20 ORDER BY total_price, listing_id LIMIT 4""",
)
def report_honorable(spark, sf):
    return _stays_report(spark, sf)["honorable_mentions"]


@query(
    "rank_offers",
    f"""WITH {OFFERS} SELECT CAST(row_number() OVER (ORDER BY total, l_orderkey, page, l_suppkey,
      nights) AS INTEGER) AS "Rank", total, l_orderkey, page, l_suppkey FROM offers""",
)
def rank_offers(spark, sf):
    order = ["total", "l_orderkey", "page", "l_suppkey", "nights"]
    ranked = with_rank(offers(spark, sf), order)
    return ranked.select("Rank", "total", "l_orderkey", "page", "l_suppkey")


def _week_rows(spark, sf):
    """In-budget homes, with every report column; all rates count for the target week."""
    size = F.col("p_size")
    extra = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("listing_id"),
        F.col("p_brand").alias("subdivision"),
        F.col("p_brand").alias("neighborhood"),
        F.col("p_type").alias("location"),
        F.col("p_type").alias("distance_to_beach"),
        F.when(size % 5 != 0, size % 2 == 0).alias("pet_friendly"),
        (size % 3 == 0).alias("private_pool"),
        (size % 4 == 0).alias("oceanfront"),
    )
    details = part_details(spark, sf)
    weeks = (
        rates(spark, sf)
        .withColumn("arrival_date", F.date_format(F.lit(TARGET).cast("date"), "M/d/yyyy"))
        .withColumn("pos", F.struct(*RATE_ORDER))
        .drop("weekly_rate")
        .withColumnRenamed("rate_display", "weekly_rate")
    )
    found = budget.week_budget_display_rate(
        part_listings(spark, sf), details, weeks, TARGET, min_bedrooms=0, max_rate=900000
    ).in_budget
    return found.join(extra, "listing_id").join(details.drop("sleeps"), "listing_id")


_WEEK_ROWS = f"""
week AS (
  SELECT * FROM rates
  QUALIFY row_number() OVER (PARTITION BY listing_id
    ORDER BY l_linenumber, l_orderkey, l_suppkey, price) = 1
),
found AS (
  SELECT l.*, weekly_rate AS rate, p_brand, p_type, p_size,
    CAST(row_number() OVER (ORDER BY weekly_rate, listing_id) AS INTEGER) AS rank
  FROM listings l JOIN week USING (listing_id) JOIN part ON listing_id = CAST(p_partkey AS VARCHAR)
  WHERE weekly_rate <= 900000
)"""
_DIRECT = """rank AS "Rank", name AS "Listing", town AS "Town", rate AS "7-Night Total",
  bedrooms AS "BR", bathrooms_full AS "Full Baths", bathrooms_half AS "Half Baths", '' AS "Why" """
_PETS = """CASE WHEN p_size % 5 = 0 THEN '' WHEN p_size % 2 = 0 THEN 'Yes' ELSE 'No' END AS "Pets OK",
  CASE WHEN p_size % 3 = 0 THEN 'Yes' ELSE 'No' END AS "Private Pool" """


@query(
    "report_carolinadesigns",
    f"""WITH {RATES}, {PART_LISTINGS}, {_WEEK_ROWS} SELECT {_DIRECT}, {_PETS}, sleeps AS "Sleeps",
      p_brand AS "Subdivision", p_type AS "Beach Proximity", url AS "URL" FROM found""",
)
def report_carolinadesigns(spark, sf):
    return report.carolinadesigns_report(_week_rows(spark, sf))


@query(
    "report_twiddy",
    f"""WITH {RATES}, {PART_LISTINGS}, {_WEEK_ROWS} SELECT {_DIRECT}, {_PETS}, sleeps AS "Sleeps",
      CASE WHEN p_size % 4 = 0 THEN 'Yes' ELSE 'No' END AS "Oceanfront", p_brand AS "Neighborhood",
      p_type AS "Beach Proximity", url AS "URL" FROM found""",
)
def report_twiddy(spark, sf):
    return report.twiddy_report(_week_rows(spark, sf))


@query(
    "report_surforsound",
    f"""WITH {RATES}, {PART_LISTINGS}, {_WEEK_ROWS} SELECT {_DIRECT}, p_type AS "Location",
      'https://www.surforsound.com/hatteras-vacation-rental/property/' || listing_id AS "URL"
    FROM found""",
)
def report_surforsound(spark, sf):
    return report.surforsound_report(_week_rows(spark, sf))


@query("report_round_trip", SQL["report_carolinadesigns"])
def report_round_trip(spark, sf):
    """All report tables written, a folder each; the largest is read back."""
    path = f"{checkpoint_dir(spark)}/listinglake/report-{uuid.uuid4().hex}"
    homes = _week_rows(spark, sf)
    write_report(
        {
            **_stays_report(spark, sf),
            "carolinadesigns": report.carolinadesigns_report(homes),
            "twiddy": report.twiddy_report(homes),
        },
        path,
    )
    return spark.read.parquet(f"{path}/carolinadesigns")
