"""Null-aware row filters.  A bound of 0 or an empty text means "not set"."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.sources.dims import check_town


def filter_range(
    df: DataFrame, column: str, low: float = 0, high: float = 0
) -> DataFrame:
    """Inclusive range; a null fails as soon as a bound is set."""
    if low:
        df = df.filter(F.col(column) >= low)
    if high:
        df = df.filter(F.col(column) <= high)
    return df


def filter_price_range(
    df: DataFrame, low: float = 0, high: float = 0, price: str = "price"
) -> DataFrame:
    return filter_range(df, price, low, high)


def filter_beds_range(
    df: DataFrame, low: int = 0, high: int = 0, bedrooms: str = "bedrooms"
) -> DataFrame:
    return filter_range(df, bedrooms, low, high)


def filter_nightly_price(
    df: DataFrame,
    low: float = 0,
    high: float = 0,
    price: str = "total_price",
    nights: str = "nights",
) -> DataFrame:
    """Bounds are per night, the price column is for the whole stay."""
    if low:
        df = df.filter(F.col(price) >= F.lit(low) * F.col(nights))
    if high:
        df = df.filter(F.col(price) <= F.lit(high) * F.col(nights))
    return df


def filter_min_bedrooms(df: DataFrame, n: int, bedrooms: str = "bedrooms") -> DataFrame:
    """An unknown count is 0, so ``n=0`` keeps it and any larger ``n`` drops it."""
    return df.filter(F.coalesce(F.col(bedrooms), F.lit(0)) >= n)


def filter_contains_ci(df: DataFrame, column: str, text: str = "") -> DataFrame:
    if not text:
        return df
    return df.filter(F.lower(column).contains(text.lower()))


def filter_listing_type(
    df: DataFrame, text: str = "", column: str = "listing_type"
) -> DataFrame:
    """"lease"/"rent" and "sale"/"buy" are aliases; other text is a substring."""
    asked = text.lower()
    for needle, aliases in (("lease", ("lease", "rent")), ("sale", ("sale", "buy"))):
        if any(a in asked for a in aliases):
            asked = needle
            break
    return filter_contains_ci(df, column, asked)


def filter_bbox(
    df: DataFrame,
    sw_lat: float,
    sw_lng: float,
    ne_lat: float,
    ne_lng: float,
    lat: str = "latitude",
    lng: str = "longitude",
) -> DataFrame:
    return df.filter(
        F.col(lat).between(sw_lat, ne_lat) & F.col(lng).between(sw_lng, ne_lng)
    )


def filter_town(df: DataFrame, source: str, town: str, column: str = "town") -> DataFrame:
    """Rows of one known town; the argument is a slug in any case."""
    slug, display = check_town(source, town)
    return df.filter(F.col(column).isin(slug, display))


def drop_missing_id(df: DataFrame, id_column: str = "listing_id") -> DataFrame:
    c = F.col(id_column)
    return df.filter(c.isNotNull() & (c.cast("string") != ""))


def filter_budget(
    df: DataFrame, limit: float = fv.BUDGET_MAX_RATE, rate: str = "rate"
) -> DataFrame:
    """Known rates up to the limit."""
    return df.filter(F.col(rate) <= limit)


def filter_stay_rule(
    df: DataFrame,
    check_ins: list[str] | None = None,
    nights: int = fv.REPORT_NIGHTS,
    min_bedrooms: int = fv.BUDGET_MIN_BEDROOMS,
    max_total: float = fv.BUDGET_MAX_RATE,
    min_rating: float = fv.REPORT_MIN_RATING,
) -> DataFrame:
    """The rule behind the stay report; an unrated listing is not a badly rated one."""
    if check_ins is not None:
        df = df.filter(F.col("check_in").isin(check_ins))
    return df.filter(
        (F.col("bedrooms") >= min_bedrooms)
        & (F.col("nights") == nights)
        & (F.col("total_price") <= max_total)
        & (F.coalesce(F.col("rating"), F.lit(min_rating)) >= min_rating)
    )
