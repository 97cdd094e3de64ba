"""Small lookup tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions.text import strip


def towns(spark: SparkSession) -> DataFrame:
    """Fixed town lookup: source, slug, external id, display name."""
    return spark.createDataFrame(
        fv.TOWNS, "source STRING, slug STRING, external_id STRING, display_name STRING"
    )


def check_town(source: str, town: str) -> tuple[str, str]:
    """(slug, display name) of a town argument; unknown towns are refused."""
    slug = town.strip().lower()
    known = {s: display for src, s, _, display in fv.TOWNS if src == source}
    if slug not in known:
        raise ValueError(f"Unknown town {town!r}. Valid towns: {', '.join(known)}")
    return slug, known[slug]


def place_key(c: Column) -> Column:
    return F.lower(strip(c))


def places(geocoder: DataFrame) -> DataFrame:
    """Geocoder responses (``query``, ``body``) -> one bounding box per query.

    The body lists candidates; the first counts.  Its box is
    [min lat, max lat, min lng, max lng] as texts.  No candidate -> no row.
    """
    rows = F.from_json(
        "body", "ARRAY<STRUCT<boundingbox: ARRAY<STRING>, display_name: STRING>>"
    )
    first = geocoder.select("query", F.get(rows, F.lit(0)).alias("hit"))

    def corner(i: int) -> Column:
        return F.get(F.col("hit.boundingbox"), F.lit(i)).try_cast("double")

    boxes = first.filter(F.col("hit").isNotNull()).select(
        place_key(F.col("query")).alias("query_key"),
        corner(0).alias("sw_lat"),
        corner(2).alias("sw_lng"),
        corner(1).alias("ne_lat"),
        corner(3).alias("ne_lng"),
        F.coalesce("hit.display_name", "query").alias("display_name"),
        "query",
    )
    # Queries that differ in case or blanks are one key; the first spelling counts.
    names = ["sw_lat", "sw_lng", "ne_lat", "ne_lng", "display_name"]
    box = F.min(F.struct("query", *names)).alias("box")
    return boxes.groupBy("query_key").agg(box).select(
        "query_key", *[F.col(f"box.{c}").alias(c) for c in names]
    )


def find_place(places_: DataFrame, city: str) -> dict:
    """Bounding box of one city text; a city without one is refused."""
    if not city or not city.strip():
        raise ValueError("Provide either city or bbox")
    rows = places_.filter(F.col("query_key") == city.strip().lower()).limit(1).collect()
    if not rows:
        raise ValueError(f"No geocoding result for {city!r}")
    return rows[0].asDict()
