"""Text clean-up and label building as column expressions."""

from __future__ import annotations

import html
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from listinglake import fixed_values as fv
from listinglake.functions.nulls import present, text_or_empty

# Ship the Arrow function by value, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Every code point Python's str.strip() removes, so trimming agrees with the
# sites' own rules; Spark's plain trim only removes the space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column, chars: str = WHITESPACE) -> Column:
    return F.btrim(c, F.lit(chars))


def group(c: Column, pattern: str, idx: int = 1) -> Column:
    """Regex group of the first match, null when there is none."""
    return present(F.regexp_extract(c, pattern, idx))


def strip_html(c: Column, entities: bool = True) -> Column:
    """Each tag -> one space, hard spaces -> spaces, trimmed; null -> ''."""
    out = F.replace(
        F.regexp_replace(c, fv.HTML_TAG, " "), F.lit("\xa0"), F.lit(" ")
    )
    if entities:
        out = F.replace(out, F.lit("&nbsp;"), F.lit(" "))
    return F.coalesce(strip(out), F.lit(""))


@F.pandas_udf(StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def html_unescape(c: Column) -> Column:
    """Decode character references.  Spark has no built-in, so this is Arrow-batched."""
    return _unescape(c)


def title_case(c: Column) -> Column:
    """Upper-case the first letter of every run of letters ("4x4" -> "4X4").

    ``initcap`` only looks at blanks, hence the split at letter boundaries.
    """
    runs = F.split(c, r"(?<=\p{L})(?=\P{L})|(?<=\P{L})(?=\p{L})")
    return F.array_join(
        F.transform(
            runs,
            lambda r: F.concat(
                F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 2**31 - 1))
            ),
        ),
        "",
    )


def town_slug(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit(" "), F.lit("-"))


def strip_number_suffix(c: Column) -> Column:
    """Drop a trailing " - #553"."""
    return strip(F.regexp_replace(c, r"\s*-\s*#\d+$", ""))


def strip_query(c: Column) -> Column:
    return F.regexp_replace(c, r"\?.*$", "")


def last_segment(c: Column) -> Column:
    """Last path segment of a URL, trailing slashes ignored."""
    return F.element_at(F.split(F.rtrim(c, F.lit("/")), "/"), -1)


def neighborhood(path: Column) -> Column:
    """Third path segment below ``outer-banks``, as a display name."""
    part = group(path, "^/*outer-banks/[^/]*/([^/]+)")
    return title_case(F.replace(part, F.lit("-"), F.lit(" ")))


def listing_type(slug: Column) -> Column:
    return (
        F.when(slug.contains("for-lease"), "For Lease")
        .when(slug.contains("for-sale"), "For Sale")
        .otherwise("Unknown")
    )


def address_line2(c: Column) -> Column:
    """"City, ST 12345" -> struct(city, state, zip); no match -> three ''."""
    line = strip(c)

    def part(i: int) -> Column:
        return F.coalesce(F.regexp_extract(line, fv.CITY_STATE_ZIP, i), F.lit(""))

    return F.struct(
        strip(part(1)).alias("city"), part(2).alias("state"), part(3).alias("zip")
    )


def drop_label(c: Column, label_pattern: str) -> Column:
    """Remove a leading label such as ``building:``."""
    return F.regexp_replace(c, "(?i)^" + label_pattern + r"\s*", "")


def village_label(c: Column) -> Column:
    """Town slug in "Village: Avon"; null when the text is not such a line."""
    return town_slug(strip(group(c, fv.VILLAGE_LINE)))


def title_subtitle(title: Column, subtitle: Column) -> Column:
    """"title: subtitle" with loose colons and blanks trimmed.

    A null side is spelled ``None``, as the source of these labels does; an empty
    side disappears.
    """
    text = F.concat(
        F.coalesce(title, F.lit("None")), F.lit(": "), F.coalesce(subtitle, F.lit("None"))
    )
    return strip(F.btrim(text, F.lit(": ")))


def full_name(first: Column, last: Column) -> Column:
    return strip(F.concat(text_or_empty(first), F.lit(" "), text_or_empty(last)))


def street_unit(street: Column, unit: Column) -> Column:
    street, unit = text_or_empty(street), text_or_empty(unit)
    return F.when(unit != "", strip(F.concat(street, F.lit(" "), unit))).otherwise(street)


def join_list(arr: Column) -> Column:
    return F.coalesce(F.array_join(arr, ", "), F.lit(""))
