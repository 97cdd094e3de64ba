"""Pairing records by id, and lookups.

Build sides are reduced to one row per key before a join, so duplicates cannot
multiply rows.  No size hints, except for the fixed town table: Spark broadcasts
by measured size and splits skewed partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listinglake.functions import ids
from listinglake.functions.text import strip
from listinglake.operators.dedupe import dedupe_first
from listinglake.operators.suffixes import with_suffixes
from listinglake.schemas import ORDER_COLUMNS
from listinglake.session import settled
from listinglake.sources.dims import place_key, towns


def combine_left(base: DataFrame, sides: list[DataFrame], key: str) -> DataFrame:
    """Left-join every side on the key; a missing side leaves nulls."""
    for side in sides:
        base = base.join(side, key, "left")
    return base


def join_unique(
    rows: DataFrame, unique: DataFrame, key: str, how: str = "inner"
) -> DataFrame:
    """Join rows whose keys may repeat a lot with a side that has each key once.

    The unique side is the result of a grouping on the key, and run-time skew
    handling does not reach through that.  So it is written first: then both sides are
    exchanged for the join, and a hot key's rows are split, equal ones too.  Files tell
    little of the size in memory, so the side is never taken for small enough to go through
    the driver.
    """
    return rows.join(settled(unique, "unique").hint("merge"), key, how)


def left_or_empty(base: DataFrame, sides: dict[str, DataFrame], key: str) -> DataFrame:
    """Left-join list-valued sides; a missing or unknown list becomes empty."""
    joined = combine_left(base, list(sides.values()), key)
    empty = F.array().cast("array<string>")
    return joined.withColumns({c: F.coalesce(F.col(c), empty) for c in sides})


def merge_details(
    listings: DataFrame,
    details: DataFrame,
    columns: list[str],
    key: str = "listing_id",
    how: str = "inner",
) -> DataFrame:
    """Listing columns plus the named detail columns; the detail wins on a clash.

    Of several detail rows for a key the first counts, so listings never multiply.
    """
    kept = [c for c in listings.columns if c not in columns]
    order = [c for c in ORDER_COLUMNS if c in details.columns and c not in columns]
    first = dedupe_first(details.select(key, *columns, *order), [key], order or columns)
    return listings.select(*kept).join(first.select(key, *columns), key, how)


def lookup_town(df: DataFrame, source: str, slug: str = "town") -> DataFrame:
    """Add ``external_id`` and ``display_name``; unknown towns drop out.

    The lookup is a fixed list of a few dozen rows, hence the hint.
    """
    dim = (
        towns(df.sparkSession)
        .filter(F.col("source") == source)
        .select(F.col("slug").alias("_slug"), "external_id", "display_name")
    )
    asked = F.lower(strip(F.col(slug)))
    return df.join(F.broadcast(dim), asked == F.col("_slug")).drop("_slug")


def lookup_place(df: DataFrame, places: DataFrame, city: str = "city") -> DataFrame:
    """Add the bounding box of the city text; no match keeps the row without one."""
    keyed = df.withColumn("query_key", place_key(F.col(city)))
    return keyed.join(places, "query_key", "left").drop("query_key")


def resolve_identifier(index: DataFrame, identifier: str) -> DataFrame:
    """First index row for one item id, property code, path or URL.

    ``index`` has ``listing_id``, ``url`` and the order columns.  A code matches
    the end of the lower-cased URL.
    """
    asked = identifier.strip()
    url = F.col("url")
    if asked.isdigit():
        hit = index.filter(F.col("listing_id") == asked)
    elif asked.startswith("http"):
        hit = index.filter(url == asked)
    elif asked.startswith("/outer-banks"):
        hit = index.filter(url.endswith(asked))
    else:
        hit = index.filter(F.lower(url).endswith(asked.lower()))
    order = [c for c in ORDER_COLUMNS if c in index.columns] or ["listing_id", "url"]
    return hit.orderBy(*order).limit(1)


def resolve_identifiers(
    requests: DataFrame,
    index: DataFrame,
    identifier: str = "identifier",
    order: list[str] | None = None,
) -> DataFrame:
    """``resolve_identifier`` for a whole table of requests.

    Ids and URLs equal the asked text, paths and codes end a URL; ``with_suffixes`` finds
    all of them.  A mark at the end tells the three kinds apart, one at the front a whole
    text.  Every entry of the index is three short texts, read once; no entry is copied
    for the lengths that codes have.
    """
    order = order or ORDER_COLUMNS
    names = list(dict.fromkeys([*order, "listing_id", "url"]))
    asked = requests.withColumn("_key", ids.sunrealty_key(F.col(identifier)))

    def id_text(c: Column) -> Column:
        return F.concat(F.lit(" "), c.cast("string"), F.lit("\x03"))

    def as_it_stands(c: Column) -> Column:
        return F.concat(c, F.lit("\x01"))

    def lowered(c: Column) -> Column:
        return F.concat(F.lower(c), F.lit("\x02"))

    key = F.col("_key")
    wanted = (
        F.when(key.rlike(r"^\d+$"), id_text(key))
        .when(key.startswith("http"), as_it_stands(F.concat(F.lit("\t"), key)))
        .when(key.startswith("/outer-banks"), as_it_stands(key))
        .when(key != "", lowered(key))
    )
    asked = asked.withColumn("_wanted", wanted)
    keys = asked.select(F.col("_wanted").alias("code")).where("code is not null").distinct()
    url = F.col("url")
    offers = F.array(
        id_text(F.col("listing_id")), as_it_stands(F.concat(F.lit("\t"), url)), lowered(url)
    )
    entries = index.select(*names, F.explode(F.array_compact(offers)).alias("_text"))
    found = with_suffixes(entries, "_text", keys, into="_wanted")
    first = F.min(F.struct(*names)).alias("_first")
    hits = found.groupBy("_wanted").agg(first).select("_wanted", "_first.listing_id", "_first.url")
    return join_unique(asked, hits, "_wanted").drop("_key", "_wanted")
