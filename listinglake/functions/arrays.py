"""Order-keeping list operations inside one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from listinglake.functions.nulls import present


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``.

    Inside a lambda Spark re-evaluates an outer expression per element; binding it
    as the lambda variable of a one-element list avoids that.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def or_empty(arr: Column, element: str = "string") -> Column:
    return F.coalesce(arr, F.array().cast(f"array<{element}>"))


def keep_present(arr: Column) -> Column:
    """Drop null and empty texts; null list -> empty list."""
    return or_empty(F.filter(arr, lambda x: present(x).isNotNull()))


def ordered_distinct(*arrays: Column) -> Column:
    """Distinct non-empty texts of the concatenated lists, first occurrence kept."""
    return F.array_distinct(F.concat(*[keep_present(a) for a in arrays]))


def distinct_by(arr: Column, key: Callable[[Column], Column]) -> Column:
    """First text per ``key(text)``, in original order.

    Sort by (key, position), keep the head of every run, sort back by position.
    """
    keyed = F.array_sort(
        F.transform(
            or_empty(arr),
            lambda x, i: F.struct(key(x).alias("k"), i.alias("i"), x.alias("x")),
        )
    )

    def heads(rows: Column) -> Column:
        kept = F.filter(
            rows,
            lambda r, j: (j == 0) | (r["k"] != F.get(rows, j - 1)["k"]),
        )
        back = F.array_sort(F.transform(kept, lambda r: F.struct(r["i"], r["x"])))
        return F.transform(back, lambda r: r["x"])

    return let(keyed, heads)


def pairs_to_map(pairs: Column) -> Column:
    """list<struct(key, value)> -> map, the last value of a key wins.

    Does not depend on the session's duplicate-key policy.
    """

    def keep_last(rev: Column) -> Column:
        keys = F.transform(rev, lambda p: p["key"])
        return let(
            keys,
            lambda ks: F.filter(
                rev, lambda p, i: F.array_position(ks, p["key"]) == i + 1
            ),
        )

    return F.map_from_entries(let(F.reverse(pairs), keep_last))


def last_where(arr: Column, test: Callable[[Column], Column]) -> Column:
    return F.try_element_at(F.filter(arr, test), F.lit(-1))


def first_where(arr: Column, test: Callable[[Column], Column]) -> Column:
    return F.get(F.filter(arr, test), F.lit(0))


def keyword_line(lines: Column, keyword: str, exclude: str | None = None) -> Column:
    """First text containing the keyword (any case) and not the excluded word."""

    def hit(t: Column) -> Column:
        found = F.lower(t).contains(keyword)
        return found & ~F.lower(t).contains(exclude) if exclude else found

    return first_where(lines, hit)
