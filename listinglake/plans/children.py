"""Weekly rates, availability windows, amenities and images of all sources.

Every source keeps these as lists of its own shape inside its detail records.  Here each
shape is mapped to the one typed table of ``schemas.CHILDREN``: dates are dates, prices
numbers, and what a source does not tell is null.  ``pos`` is the place in the list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from listinglake import fixed_values as fv
from listinglake import schemas
from listinglake.functions import dates, numbers
from listinglake.functions.nulls import present
from listinglake.operators.union import union_all
from listinglake.session import settled
from listinglake.sources.sinks import deal_to_folders


def _entries(table: str, items: Column, make: dict) -> Column:
    """A list in the table's shape; ``make`` gives the fields that a source has."""
    return F.transform(
        items,
        lambda x: F.struct(
            *[
                (make[f.name](x) if f.name in make else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schemas.child_fields(table)
            ]
        ),
    )


def _day(c: Column) -> Column:
    return c.try_cast("date")


def _titles(column: str, available: bool | None) -> Column:
    return _entries(
        "amenities", F.col(column), {"title": lambda t: t, "available": lambda t: F.lit(available)}
    )


def _display_weeks() -> Column:
    """Prices as the page shows them; a week that is taken has none."""
    return _entries(
        "weekly_rates",
        F.col("weekly_rates"),
        {
            "arrive": lambda w: dates.us_date(w["arrival_date"]),
            "rate": lambda w: numbers.dollar_amount(w["weekly_rate"]),
            "rate_display": lambda w: w["weekly_rate"],
            "nightly_display": lambda w: w["nightly_rate"],
            "is_available": lambda w: w["weekly_rate"].isNotNull(),
            "book_type": lambda w: w["book_type"],
        },
    )


def _special_weeks() -> Column:
    return _entries(
        "weekly_rates",
        F.col("weekly_availabilities"),
        {
            "arrive": lambda w: _day(w["start_date"]),
            "rate": lambda w: w["rate"],
            "rate_display": lambda w: w["formatted_rate"],
            "reference_rate": lambda w: w["reference_rate"],
            "is_on_special": lambda w: w["is_on_special"],
        },
    )


def _open_weeks() -> Column:
    return _entries(
        "weekly_rates",
        F.col("weekly_rates"),
        {
            "arrive": lambda w: _day(present(w["arrive"])),
            "depart": lambda w: _day(present(w["depart"])),
            "rate": lambda w: w["weekly_rate"],
            "is_available": lambda w: w["is_available"],
            "note": lambda w: w["week_content"],
        },
    )


def _windows() -> Column:
    return _entries(
        "availability_windows",
        F.col("availability_windows"),
        {
            "start": lambda w: _day(w["start"]),
            "end": lambda w: _day(w["end"]),
            "available": lambda w: w["available"],
        },
    )


def _both_amenities() -> Column:
    """What a stay offers, then what it says it lacks."""
    return F.concat(_titles("amenities", True), _titles("unavailable_amenities", False))


def _listed_amenities() -> Column:
    return _titles("amenities", True)


def _images() -> Column:
    return _entries("images", F.col("image_urls"), {"url": lambda u: u})


# Which list of a source's details becomes which table.
SHAPES = {
    "weekly_rates": {
        fv.CAROLINADESIGNS: _display_weeks,
        fv.SURFORSOUND: _special_weeks,
        fv.TWIDDY: _open_weeks,
    },
    "availability_windows": {fv.SUNREALTY: _windows},
    "amenities": {
        fv.STAYS: _both_amenities,
        fv.CAROLINADESIGNS: _listed_amenities,
        fv.SUNREALTY: _listed_amenities,
        fv.SURFORSOUND: _listed_amenities,
        fv.TWIDDY: _listed_amenities,
    },
    "images": {
        fv.STAYS: _images,
        fv.CAROLINADESIGNS: _images,
        fv.CHURCHREALTY: _images,
        fv.CREXI: _images,
        fv.REDFIN: _images,
        fv.SUNREALTY: _images,
        fv.SURFORSOUND: _images,
        fv.TWIDDY: _images,
    },
}


def child_table(details: dict[str, DataFrame], table: str) -> DataFrame:
    """The rows of one child table over the details of all sources that have it.

    A missing or null list gives no rows.  Sources without such a list are passed over.
    """
    parts = [
        details[source].select(
            F.lit(source).alias("source"),
            F.col("listing_id").cast("string").alias("listing_id"),
            F.posexplode(shape()).alias("pos", "_entry"),
        )
        for source, shape in SHAPES[table].items()
        if source in details
    ]
    if not parts:
        raise ValueError(f"no source with {table}")
    return union_all(parts).select("source", "listing_id", "pos", "_entry.*")


def child_tables(details: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All child tables that the given sources have.

    For several tables, the details are parsed once: their lists are written in one pass, and
    each table reads its own column.
    """
    tables = [t for t, shapes in SHAPES.items() if any(source in details for source in shapes)]
    if len(tables) < 2 or any(rows.isStreaming for rows in details.values()):
        return {table: child_table(details, table) for table in tables}
    lists = settled(union_all([_lists(rows, source, tables) for source, rows in details.items()]), "lists")
    return {
        table: lists.select("source", "listing_id", F.posexplode(table).alias("pos", "_entry"))
        .select("source", "listing_id", "pos", "_entry.*")
        for table in tables
    }


def _lists(details: DataFrame, source: str, tables: list[str]) -> DataFrame:
    """A source's lists, a column per table; null where the source has none."""

    def column(table: str) -> Column:
        shape = SHAPES[table].get(source)
        kind = ArrayType(StructType(schemas.child_fields(table)))
        return (shape() if shape else F.lit(None)).cast(kind).alias(table)

    return details.select(
        F.lit(source).alias("source"),
        F.col("listing_id").cast("string").alias("listing_id"),
        *[column(table) for table in tables],
    )


def write_children(tables: dict[str, DataFrame], path: str, mode: str = "append") -> None:
    """A folder per table, in it one per source."""
    for name, rows in tables.items():
        dealt = deal_to_folders(rows, ["source"]).sortWithinPartitions("source", "listing_id", "pos")
        dealt.write.mode(mode).partitionBy("source").parquet(f"{path}/{name}")


def read_children(spark, path: str, table: str) -> DataFrame:
    """A child table as written; a test on ``source`` opens that source's folder only."""
    rows = spark.read.schema(schemas.CHILDREN[table]).parquet(f"{path}/{table}")
    return rows.select(*[f.split()[0] for f in schemas.CHILDREN[table].split(",")])
