"""Numbers inside text, as column expressions.

Every function returns null when the text has no such number.  Values too large
for the target type are null as well.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions.nulls import present
from listinglake.functions.text import group, strip


def _no_commas(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(""))


def int_from_text(c: Column) -> Column:
    """"studio" counts as 0, otherwise the first run of digits."""
    return F.when(F.lower(c).contains("studio"), F.lit(0)).otherwise(
        group(c, fv.FIRST_INT).try_cast("int")
    )


def float_from_text(c: Column) -> Column:
    """"half" counts as 0.5, otherwise the first decimal number."""
    return F.when(F.lower(c).contains("half"), F.lit(0.5)).otherwise(
        group(c, fv.FIRST_DECIMAL).try_cast("double")
    )


def price_and_currency(c: Column) -> Column:
    """"$1,450" -> struct(amount, currency)."""
    return F.struct(
        _no_commas(group(c, fv.CURRENCY_AMOUNT, 2)).try_cast("double").alias("amount"),
        present(strip(group(c, fv.CURRENCY_AMOUNT, 1))).alias("currency"),
    )


def dollar_amount(c: Column) -> Column:
    return _no_commas(group(c, fv.DOLLAR_AMOUNT)).try_cast("double")


def int_with_commas(c: Column) -> Column:
    return _no_commas(group(c, fv.COMMA_INT)).try_cast("int")


def float_with_commas(c: Column) -> Column:
    return _no_commas(group(c, fv.COMMA_DECIMAL)).try_cast("double")


def whole(c: Column, kind: str = "int") -> Column:
    """A whole number that stands as 7, 7.0, "7" or "7.0"; anything else is null."""
    text = strip(c.cast("string"))
    value = text.try_cast("double")
    return F.coalesce(text.try_cast(kind), F.when(value == F.floor(value), value).try_cast(kind))


def leading_int(c: Column) -> Column:
    return group(c.cast("string"), r"^(\d+)").try_cast("int")


def beds_text(c: Column) -> Column:
    return group(c, fv.FIRST_INT).try_cast("int")


def _baths(full: Column, half: Column) -> Column:
    return F.struct(full.cast("int").alias("full"), half.cast("int").alias("half"))


def baths_slash(c: Column) -> Column:
    """"15/2" -> (15, 2); "3" -> (3, 0); missing -> (null, null)."""
    text = present(c)
    parts = F.split(text, "/")
    full = leading_int(strip(F.get(parts, F.lit(0))))
    half = F.coalesce(leading_int(strip(F.get(parts, F.lit(1)))), F.lit(0))
    return _baths(full, F.when(text.isNotNull(), half))


def baths_words(c: Column) -> Column:
    """"8 Full, 2 Half" -> (8, 2); no half -> 0; missing -> (null, null)."""
    text = present(c)
    full = group(text, r"(?i)(\d+)\s+Full").try_cast("int")
    half = F.coalesce(group(text, r"(?i)(\d+)\s+Half").try_cast("int"), F.lit(0))
    return _baths(full, F.when(text.isNotNull(), half))


def baths_float(c: Column) -> Column:
    """3.5 -> (3, 1): a large enough fraction is one half bath."""
    full = c.cast("int")
    half = F.when(c - full >= fv.HALF_BATH_FRACTION, 1).otherwise(0)
    return _baths(full, F.when(c.isNotNull(), half))


def baths_text(c: Column) -> Column:
    """"Bathrooms: 3 & 1 Half" -> (3, 1); the second number needs the word half."""
    numbers = F.regexp_extract_all(c, F.lit(fv.FIRST_INT), F.lit(1))
    full = F.get(numbers, F.lit(0)).try_cast("int")
    half = F.when(
        (F.size(numbers) > 1) & F.lower(c).contains("half"),
        F.get(numbers, F.lit(1)).try_cast("int"),
    ).otherwise(0)
    return _baths(full, F.when(F.size(numbers) > 0, half))


def baths_labelled(lines: Column) -> Column:
    """["Full Bathrooms: 15", "Half Bathrooms 2"] -> (15, 2); last of a kind wins."""
    readable = F.filter(lines, lambda e: e.rlike(r"\d"))

    def last_count(items: Column) -> Column:
        return group(
            F.try_element_at(items, F.lit(-1)), fv.FIRST_INT
        ).try_cast("int")

    full = F.filter(readable, lambda e: F.lower(e).contains("full"))
    half = F.filter(
        readable, lambda e: F.lower(e).contains("half") & ~F.lower(e).contains("full")
    )
    return _baths(last_count(full), last_count(half))


def review_count(c: Column) -> Column:
    """Count in "4.9 (1,234)"."""
    return _no_commas(group(c, fv.REVIEWS_IN_PARENS)).try_cast("int")


def sleeps_in_list(arr: Column) -> Column:
    """First "(Sleeps 25)" over a list of texts."""
    found = F.filter(arr, lambda t: t.rlike(fv.SLEEPS_IN_PARENS))
    return group(F.get(found, F.lit(0)), fv.SLEEPS_IN_PARENS).try_cast("int")


def rate_range(c: Column) -> Column:
    """"Weekly: $2,995 - $14,495" -> struct(low, high)."""
    return F.struct(
        _no_commas(group(c, fv.WEEKLY_RANGE, 1)).try_cast("double").alias("low"),
        _no_commas(group(c, fv.WEEKLY_RANGE, 2)).try_cast("double").alias("high"),
    )
