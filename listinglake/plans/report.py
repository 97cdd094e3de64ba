"""Report tables: one per sheet, with that sheet's columns.

"Why" is written by a person; it is an empty column here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions import urls
from listinglake.functions.nulls import yes_no
from listinglake.operators.filters import filter_stay_rule
from listinglake.operators.offers import cheapest_offer
from listinglake.operators.topk import top_and_honorable, with_rank


def _sheet(df: DataFrame, headers: list[str], values: dict[str, Column | str]) -> DataFrame:
    columns = {"Why": F.lit(""), **values}
    return df.select(
        *[
            (F.col(c) if isinstance(c, str) else c).alias(h)
            for h, c in ((h, columns.get(h, h)) for h in headers)
        ]
    )


def stays_report(
    offers: DataFrame,
    order: list[str],
    *,
    top_n: int,
    honorable_n: int,
    min_reviews: int,
    check_ins: list[str] | None = None,
    town: str = "town",
) -> dict[str, DataFrame]:
    """Top picks (ranked) and honorable mentions of the cheapest offers."""
    best = cheapest_offer(filter_stay_rule(offers, check_ins), order)
    top, honorable = top_and_honorable(best, top_n, honorable_n, min_reviews)
    values = {
        "Listing": "name",
        "Town": town,
        "7-Night Total": "total_price",
        "BR": "bedrooms",
        "Beds": "beds",
        "Baths": "bathrooms",
        "Rating": "rating",
        "Reviews": F.coalesce(F.col("review_count"), F.lit(0)),
        "Check-in": "check_in",
        "URL": "url",
    }
    ranked = with_rank(top, ["total_price", "listing_id"], top_n)
    unranked = honorable.withColumn("Rank", F.lit(None).cast("int"))
    return {
        "top_picks": _sheet(ranked, fv.STAYS_REPORT, values),
        "honorable_mentions": _sheet(unranked, fv.STAYS_REPORT, values),
    }


_DIRECT = {
    "Listing": "name",
    "Town": "town",
    "7-Night Total": "rate",
    "BR": "bedrooms",
    "Full Baths": "bathrooms_full",
    "Half Baths": "bathrooms_half",
    "Sleeps": "sleeps",
    "URL": "url",
}


def carolinadesigns_report(in_budget: DataFrame, n: int | None = None) -> DataFrame:
    return _sheet(
        with_rank(in_budget, ["rate", "listing_id"], n),
        fv.CAROLINADESIGNS_REPORT,
        {
            **_DIRECT,
            "Subdivision": "subdivision",
            "Beach Proximity": "location",
            "Pets OK": yes_no(F.col("pet_friendly")),
            "Private Pool": yes_no(F.col("private_pool")),
        },
    )


def twiddy_report(in_budget: DataFrame, n: int | None = None) -> DataFrame:
    return _sheet(
        with_rank(in_budget, ["rate", "listing_id"], n),
        fv.TWIDDY_REPORT,
        {
            **_DIRECT,
            "Neighborhood": "neighborhood",
            "Beach Proximity": "distance_to_beach",
            "Oceanfront": yes_no(F.col("oceanfront")),
            "Pets OK": yes_no(F.col("pet_friendly")),
            "Private Pool": yes_no(F.col("private_pool")),
        },
    )


def surforsound_report(in_budget: DataFrame, n: int | None = None) -> DataFrame:
    return _sheet(
        with_rank(in_budget, ["rate", "listing_id"], n),
        fv.SURFORSOUND_REPORT,
        {
            **_DIRECT,
            "Location": "location",
            "URL": urls.from_id(fv.SURFORSOUND_DETAIL, F.col("listing_id")),
        },
    )
