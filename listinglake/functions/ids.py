"""Identifiers: any accepted spelling -> canonical id, null when there is none.

At table scale an unreadable id is a null to be filtered or quarantined, not an
error that stops the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions.nulls import first_present
from listinglake.functions.text import group, strip

_DIGITS = r"^\d+$"


def _digits(c: Column) -> Column:
    return F.when(c.rlike(_DIGITS), c)


def decode_stay_id(c: Column) -> Column:
    """base64("DemandStayListing:100") -> "100"; not base64 or not text -> null."""
    clean = F.regexp_replace(c, "[^A-Za-z0-9+/=]", "")
    whole = F.regexp_extract(clean, "^(?:.{4})*$", 0)
    text = F.try_validate_utf8(F.try_to_binary(whole, F.lit("base64")).cast("string"))
    return group(text, "(?s)^(?:[^:]*:)?(.*)$")


def stays_id(c: Column) -> Column:
    return F.coalesce(group(c, r"/rooms/(\d+)"), _digits(c))


def carolinadesigns_id(c: Column) -> Column:
    return F.coalesce(group(c, r"/(\d+)(?:[^\d/]|$)"), _digits(strip(c)))


def churchrealty_id(c: Column) -> Column:
    """Slug behind ``/property/``, or the text itself."""
    text = F.rtrim(strip(c.cast("string")), F.lit("/"))
    return F.element_at(F.split(text, "/property/"), -1)


def crexi_id(c: Column) -> Column:
    text = strip(c.cast("string"))
    return F.coalesce(group(text, r"/(\d+)$"), _digits(text))


def redfin_id(c: Column) -> Column:
    text = strip(c.cast("string"))
    return F.coalesce(group(text, r"/home/(\d+)"), _digits(text))


def sunrealty_key(c: Column) -> Column:
    """Digits, URLs and site paths stay as they are; a property code is lowered."""
    text = strip(c.cast("string"))
    as_is = text.rlike(_DIGITS) | text.startswith("http") | text.startswith("/outer-banks")
    return F.when(as_is, text).otherwise(F.lower(text))


def surforsound_id(c: Column) -> Column:
    text = strip(c.cast("string"))
    return F.coalesce(_digits(text), group(text, r"/property/(\d+)")).try_cast("bigint")


def twiddy_id(c: Column) -> Column:
    return _digits(strip(c.cast("string"))).try_cast("bigint")


def twiddy_page_id(body: Column) -> Column:
    """Property id embedded in a detail page."""
    return group(body, fv.TWIDDY_PAGE_ID).try_cast("bigint")


def sunrealty_page_id(body: Column) -> Column:
    """``item_id`` in the page, else ``eid``, else ''."""
    return F.coalesce(
        group(body, r'"item_id"\s*:\s*"?(\d+)"?'),
        group(body, r'"eid"\s*:\s*"?(\d+)"?'),
        F.lit(""),
    )


def home_id(url: Column, property_id: Column, listing_id: Column) -> Column:
    """The id in the URL wins over the id fields."""
    return F.coalesce(
        group(url, r"/home/(\d+)"), first_present(property_id, listing_id)
    )
