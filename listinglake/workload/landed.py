"""Searches over landing folders that Spark writes first, laid out by request key."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.plans import landed as plans
from listinglake.plans.normalize import search_tables
from listinglake.session import checkpoint_dir
from listinglake.sources.landing_store import read_landing, write_landing
from listinglake.workload import html_sources as pages
from listinglake.workload import json_sources as bodies
from listinglake.workload.tables import query, table

STAYS = f"WITH {bodies.HOMES}, {bodies._STAYS}"


def landing_of(spark, responses: DataFrame) -> DataFrame:
    path = f"{checkpoint_dir(spark)}/listinglake/landing-{uuid.uuid4().hex}"
    write_landing(responses, path)
    return read_landing(spark, path)


@query(
    "landed_village_search",
    f"""WITH {pages.HOMES}, {pages._SOS} SELECT * EXCLUDE (page, pos) FROM sos
    WHERE town = 'frisco' AND check_in = '2026-08-15' AND coalesce(bedrooms, 0) >= 5
    ORDER BY page, pos LIMIT 30""",
)
def landed_village_search(spark, sf):
    landing = landing_of(spark, pages.surforsound_search_responses(spark, sf))
    return plans.search_village(landing, "Frisco", 5, 30, "2026-08-15").rows


@query(
    "landed_sunrealty_search",
    f"""WITH {bodies.HOMES}, {bodies._SUN} SELECT * EXCLUDE (page, pos) FROM sun
    WHERE town = 'Carova / 4x4 Beaches' AND coalesce(bedrooms, 0) >= 4
    ORDER BY page, pos LIMIT 50""",
)
def landed_sunrealty_search(spark, sf):
    landing = landing_of(spark, bodies.sunrealty_search_responses(spark, sf))
    found = plans.search_sunrealty_town(landing, "4x4", 4).rows
    return found.withColumn("featured_amenities", F.array_join("featured_amenities", "|"))


@query(
    "landed_twiddy_search",
    f"""WITH {bodies.HOMES}, {bodies._TW} SELECT * EXCLUDE (page, pos) FROM tw
    WHERE town = 'duck' AND coalesce(bedrooms, 0) >= 6 ORDER BY page, pos LIMIT 100""",
)
def landed_twiddy_search(spark, sf):
    landing = landing_of(spark, bodies.twiddy_search_responses(spark, sf))
    return plans.search_twiddy_town(landing, " Duck", 6, 100).rows


@query(
    "landed_carolinadesigns_search",
    f"""WITH {bodies.HOMES}, {bodies._CD} SELECT * EXCLUDE (page, pos) FROM cd
    WHERE town = 'nags-head' AND coalesce(bedrooms, 0) >= 3 ORDER BY page, pos LIMIT 75""",
)
def landed_carolinadesigns_search(spark, sf):
    landing = landing_of(spark, bodies.carolinadesigns_search_responses(spark, sf))
    return plans.search_carolinadesigns_town(landing, "nags-head", 3, 75).rows


@query(
    "landed_stays_search",
    f"""{STAYS} SELECT * EXCLUDE (page, pos) FROM stays
    WHERE check_in = '2026-02-07' AND nights = 4 AND latitude BETWEEN 35 AND 46
      AND longitude BETWEEN -83 AND -80 AND coalesce(bedrooms, 0) >= 1
      AND total_price >= 60 * 4 AND total_price <= 1800 * 4
    ORDER BY page, pos LIMIT 20""",
)
def landed_stays_search(spark, sf):
    place = {
        "sw_lat": 35.0, "sw_lng": -83.0, "ne_lat": 46.0, "ne_lng": -80.0, "display_name": "Sound",
    }
    landing = landing_of(spark, bodies.stays_search_responses(spark, sf))
    return plans.search_stays_landed(
        landing, check_in="2026-02-07", nights=4, place=place, min_bedrooms=1, price_min=60,
        price_max=1800, max_results=20,
    ).rows


def asked_dates(spark, sf):
    """Arrival dates that somebody asked for, with the nights: one per nation."""
    key = F.col("n_nationkey")
    return table(spark, sf, "nation").select(
        F.date_add(F.lit("2026-01-03").cast("date"), (key % 20 * 7).cast("int")).alias("check_in"),
        (F.col("n_regionkey") + 2).cast("int").alias("nights"),
    )


@query(
    "landed_dates_search",
    f"""{STAYS}, asked AS (
      SELECT DISTINCT strftime(DATE '2026-01-03' + CAST(n_nationkey % 20 * 7 AS INTEGER), '%Y-%m-%d')
        AS day FROM nation WHERE n_regionkey + 2 = 4),
    firsts AS (
      SELECT * FROM stays JOIN asked ON check_in = day
      WHERE nights = 4 AND coalesce(bedrooms, 0) >= 2
      QUALIFY row_number() OVER (PARTITION BY check_in, listing_id ORDER BY page, pos) = 1),
    dated AS (
      SELECT * FROM firsts WHERE total_price <= 2000 * 4
      QUALIFY row_number() OVER (PARTITION BY check_in ORDER BY page, pos) <= 40),
    best AS (
      SELECT * FROM dated QUALIFY row_number() OVER (PARTITION BY listing_id
        ORDER BY (total_price IS NULL), total_price, check_in, page, pos) = 1),
    seen AS (SELECT listing_id, min(struct_pack(a := check_in, b := page, c := pos)) AS first_seen
      FROM dated GROUP BY listing_id)
    SELECT best.* EXCLUDE (page, pos, day) FROM best JOIN seen USING (listing_id)
    ORDER BY (total_price IS NULL), total_price, first_seen LIMIT 40""",
)
def landed_dates_search(spark, sf):
    landing = landing_of(spark, bodies.stays_search_responses(spark, sf))
    return plans.search_stays_on_asked_dates(
        landing, asked_dates(spark, sf), 4, min_bedrooms=2, price_max=2000, max_results=40
    ).rows


@query(
    "landed_refetched",
    f"WITH {bodies.HOMES}, {bodies._REDFIN} SELECT * FROM redfin",
)
def landed_refetched(spark, sf):
    """Every request landed several times; old fetches go before a body is parsed."""
    landing = landing_of(spark, bodies.refetched(bodies.redfin_search_responses(spark, sf), "old"))
    return search_tables(landing, fv.REDFIN).rows
