"""Detail lookup for one listing or a table of requests, by any accepted spelling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions import ids, urls
from listinglake.functions.text import strip
from listinglake.operators.dedupe import dedupe_first
from listinglake.operators.joins import join_unique, resolve_identifier, resolve_identifiers
from listinglake.schemas import ORDER_COLUMNS
from listinglake.session import settled

CANONICAL_ID = {
    fv.STAYS: ids.stays_id,
    fv.CAROLINADESIGNS: ids.carolinadesigns_id,
    fv.CHURCHREALTY: ids.churchrealty_id,
    fv.CREXI: ids.crexi_id,
    fv.REDFIN: ids.redfin_id,
    fv.SURFORSOUND: ids.surforsound_id,
    fv.TWIDDY: ids.twiddy_id,
}


def _known_id(df: DataFrame, c: Column, asked: str) -> object:
    """The canonical id as a value; refused when the text holds none."""
    found = df.sparkSession.sql("SELECT 1").select(c).first()[0]
    if found is None:
        raise ValueError(f"Cannot extract listing ID from {asked!r}")
    return found


def find_details(
    details: DataFrame,
    source: str,
    identifier: str | int,
    index: DataFrame | None = None,
) -> DataFrame:
    """Rows of one listing.

    A URL or path names its page and needs no ``index`` (search rows with ``url``).  Ids
    and codes of the source that keeps them in URLs are looked up there, or among the
    details' own URLs when there is none.
    """
    asked = str(identifier).strip()
    if source == fv.SUNREALTY:
        if asked.startswith(("http", "/outer-banks")):
            return details.filter(same_page(F.col("url")) == same_page(_page(source, F.lit(asked))))
        hit = resolve_identifier(details if index is None else index, asked)
        return details.join(hit.select("url"), "url", "left_semi")
    if source == fv.TWIDDY and (fv.TWIDDY_BASE in asked or asked.startswith("/outer-banks/")):
        return details.filter(same_page(F.col("url")) == same_page(_page(source, F.lit(asked))))
    text = str(identifier) if source == fv.STAYS else asked
    key = _known_id(details, CANONICAL_ID[source](F.lit(text)), asked)
    return details.filter(F.col("listing_id") == key)


BASE = {fv.SUNREALTY: fv.SUNREALTY_BASE, fv.TWIDDY: fv.TWIDDY_BASE}


def same_page(url: Column) -> Column:
    """A slash at the end of a URL makes no other page of it."""
    return F.rtrim(url, F.lit("/"))


def _page(source: str, c: Column) -> Column:
    """The URL that a request names, null when it is an id or a code."""
    text = strip(c.cast("string"))
    page = F.when(text.startswith("/outer-banks"), urls.absolute_path(text, BASE[source]))
    return page.when(text.startswith("http"), text)


def find_all_details(
    requests: DataFrame,
    details: DataFrame,
    source: str,
    identifier: str = "identifier",
    index: DataFrame | None = None,
    pages: DataFrame | None = None,
) -> DataFrame:
    """``requests`` with the detail row that each one means; those without one drop out.

    What a request may be called by is tried in this order, and the first hit counts:

    1. its URL or path, as the page that landed under it;
    2. the id inside a landed page of that URL (``pages``: entity_id, body), for the
       source whose URLs carry none;
    3. an id, as the details have it;
    4. an id or code, as the search rows have it (``index``), or the details' own URLs.

    Each way is a column of keys on one union of (key, rank), so requests and the names of
    details are exchanged once for all of them.  ``found_by`` names the way.
    """
    if source not in BASE:
        raise ValueError(f"no pages are looked up for {source}")
    # One detail row per page and id: repeats would multiply requests.  They are written, as
    # they are read for their names, for codes, and for the rows that are meant in the end.
    rows = settled(dedupe_first(details, ["listing_id", "url"], _order(details)), "details")
    text = strip(F.col(identifier).cast("string"))
    asked = requests.withColumns(
        {"_asked": text, "_page": same_page(_page(source, text))}
    )
    named = asked.select("_asked", "_page").filter("_asked != ''").distinct()

    def way(rank: int, by: str, key: Column, pairs: DataFrame) -> DataFrame:
        return pairs.select("_asked", F.lit(rank).alias("_rank"), F.lit(by).alias("found_by"), key.alias("_key"))

    ways = [
        way(0, "url", F.concat(F.lit("u"), "_page"), named),
        way(2, "id", F.concat(F.lit("i"), "_asked"), named.filter("_page is null")),
    ]
    if pages is not None:
        inside = pages.select(
            same_page(_page(source, F.col("entity_id"))).alias("_page"),
            _page_id(source, F.col("body")).cast("string").alias("_inside"),
        )
        inside = inside.filter("_inside != ''").groupBy("_page").agg(F.min("_inside").alias("_inside"))
        ways.append(way(1, "page", F.concat(F.lit("i"), "_inside"), named.join(inside, "_page")))
    if source == fv.SUNREALTY:
        known = rows if index is None else index
        hits = resolve_identifiers(
            named.filter("_page is null").select("_asked"), known, "_asked", _order(known)
        )
        ways.append(
            way(3, "index", F.concat(F.lit("u"), same_page(F.col("url"))), hits)
        )
    # Names lead to a home's id and page; its row is fetched once, behind all choices.
    home, own = F.struct("listing_id", "url").alias("_home"), "_detail"
    named_rows = rows.select(
        home, F.col("listing_id").cast("string").alias("_id"), same_page(F.col("url")).alias("_url")
    )
    keys = named_rows.select(
        "*", F.explode(F.array(F.concat(F.lit("u"), "_url"), F.concat(F.lit("i"), "_id"))).alias("_key")
    ).filter("_key is not null")
    keys = dedupe_first(keys, ["_key"], ["_id", "_url"]).select("_key", "_home")
    wanted = ways[0]
    for more in ways[1:]:
        wanted = wanted.unionByName(more)
    hits = wanted.filter("_key is not null").join(keys, "_key")
    best = hits.groupBy("_asked").agg(F.min_by(F.struct("found_by", "_home"), "_rank").alias("_hit"))
    best = best.select("_asked", "_hit.found_by", "_hit._home")
    homes = rows.select(home, F.struct(*rows.columns).alias(own)).hint("merge")
    found = join_unique(asked, best, "_asked").join(homes, "_home")
    taken = set(requests.columns) | {"found_by"}
    return found.select(
        *requests.columns, "found_by",
        *[F.col(f"{own}.{c}").alias(c) for c in details.columns if c not in taken],
    )


def _order(df: DataFrame) -> list[str]:
    """The order columns a table has, else its id and URL."""
    have = [c for c in ORDER_COLUMNS if c in df.columns]
    return have or ["listing_id", "url"]


def _page_id(source: str, body: Column) -> Column:
    return ids.twiddy_page_id(body) if source == fv.TWIDDY else ids.sunrealty_page_id(body)
