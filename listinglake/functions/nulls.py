"""Missing-value rules as column expressions.

Sources mix two encodings of "missing": null and the empty string.  ``present``
folds both into null; the callers decide which one comes out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(c: Column) -> Column:
    """Empty string -> null.

    Names ``c`` only once: ``nullif`` expands to an expression that holds it twice,
    and nested text functions would then double in size at every level.
    """
    return F.get(F.array_remove(F.array(c), ""), F.lit(0))


def first_present(*cols: Column) -> Column:
    """First value that is neither null nor empty, else null."""
    return F.coalesce(*[present(c) for c in cols])


def text_or_empty(*cols: Column) -> Column:
    """First value that is neither null nor empty, else the empty string."""
    return F.coalesce(*[present(c) for c in cols], F.lit(""))


def null_if_in(c: Column, sentinels: list[str]) -> Column:
    """Listed sentinel texts -> null."""
    return F.when(~c.isin(sentinels), c)


def truthy(c: Column) -> Column:
    """Nullable flag -> non-null flag."""
    return F.coalesce(c, F.lit(False))


def flag_one(c: Column) -> Column:
    """Text or number "1" means true, everything else (or missing) false."""
    return F.coalesce(c.cast("string"), F.lit("0")) == F.lit("1")


def yes_no(c: Column) -> Column:
    """Three-state flag for reports: Yes, No, or empty when unknown."""
    return F.when(c, "Yes").when(~c, "No").otherwise("")


def equals_ci(c: Column, text: str) -> Column:
    return F.coalesce(F.lower(c) == F.lit(text.lower()), F.lit(False))


def safe_int(c: Column) -> Column:
    """Text or number to int; anything unreadable -> null."""
    return c.cast("string").try_cast("int")


def first_or(arr: Column, default: Column) -> Column:
    """First list element; the default only when the list is null or empty."""
    return F.when(F.size(arr) > 0, F.get(arr, F.lit(0))).otherwise(default)


def map_first_present(m: Column, keys: list[str]) -> Column:
    """Value of the first key holding a non-empty text."""
    return F.coalesce(*[present(F.try_element_at(m, F.lit(k))) for k in keys])


def map_decimal(m: Column, keys: list[str]) -> Column:
    """Number under the first filled key; that key decides even if unreadable."""
    return F.regexp_replace(map_first_present(m, keys), ",", "").try_cast("double")


def keyed_value(arr: Column, key: str) -> Column:
    """``value`` of the first struct in a key/value list with this ``key``."""
    hit = F.get(F.filter(arr, lambda e: e["key"] == F.lit(key)), F.lit(0))
    return hit["value"]
