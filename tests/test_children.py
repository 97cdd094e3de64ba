"""Child tables: one typed shape for the lists of all sources."""

import datetime as dt

import pytest

from listinglake import fixed_values as fv
from listinglake import schemas
from listinglake.plans.children import (
    SHAPES, child_table, child_tables, read_children, write_children,
)
from listinglake.schemas import record_schema


def details(spark, source, *rows):
    """Detail records with the given fields; all others are null."""
    schema = record_schema(f"{source}_details")
    full = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(full, schema)


def typed(df, table):
    want = schemas.StructType.fromDDL(schemas.CHILDREN[table])
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in want]
    return sorted(map(tuple, df.collect()))


def test_weeks_of_three_shapes(spark):
    got = child_table(
        {
            fv.CAROLINADESIGNS: details(spark, fv.CAROLINADESIGNS, {
                "listing_id": "9", "weekly_rates": [
                    ("8/1/2026", "$1,234.50", "$180", "NORM"), ("soon", None, "Booked", None)]}),
            fv.SURFORSOUND: details(spark, fv.SURFORSOUND, {
                "listing_id": 5, "weekly_availabilities": [("2026-07-04", 900.0, "$900", 950.0, True), (None, None, None, None, False)]}),
            fv.TWIDDY: details(spark, fv.TWIDDY,
                {"listing_id": 7, "weekly_rates": [("2026-05-02", "2026-05-09", 400.0, True, "two"), ("", "", None, False, None)]},
                {"listing_id": 8, "weekly_rates": []}, {"listing_id": 9}),
        },
        "weekly_rates",
    )
    n = None
    assert typed(got, "weekly_rates") == [
        ("carolinadesigns", "9", 0, dt.date(2026, 8, 1), n, 1234.5, "$1,234.50", "$180", n, True, n, "NORM", n),
        ("carolinadesigns", "9", 1, n, n, n, n, "Booked", n, False, n, n, n),
        ("surforsound", "5", 0, dt.date(2026, 7, 4), n, 900.0, "$900", n, 950.0, n, True, n, n),
        ("surforsound", "5", 1, n, n, n, n, n, n, n, False, n, n),
        ("twiddy", "7", 0, dt.date(2026, 5, 2), dt.date(2026, 5, 9), 400.0, n, n, n, True, n, n, "two"),
        ("twiddy", "7", 1, n, n, n, n, n, n, False, n, n, n),
    ]


def test_windows_have_dates(spark):
    rows = details(spark, fv.SUNREALTY, {
        "listing_id": "a", "availability_windows": [("2026-05-01", "2026-05-09", True), ("2026-13-01", "x", False)]})
    assert typed(child_table({fv.SUNREALTY: rows}, "availability_windows"), "availability_windows") == [
        ("sunrealty", "a", 0, dt.date(2026, 5, 1), dt.date(2026, 5, 9), True),
        ("sunrealty", "a", 1, None, None, False),
    ]


def test_amenities_that_are_missing_follow_those_that_are_there(spark):
    stays = details(
        spark, fv.STAYS,
        {"listing_id": "s", "amenities": ["Wifi", "Deck"], "unavailable_amenities": ["Lift"]},
        {"listing_id": "t", "amenities": [], "unavailable_amenities": ["Wifi"]},
    )
    twiddy = details(spark, fv.TWIDDY, {"listing_id": 3, "amenities": ["Pool"]})
    assert typed(child_table({fv.STAYS: stays, fv.TWIDDY: twiddy}, "amenities"), "amenities") == [
        ("stays", "s", 0, "Wifi", True), ("stays", "s", 1, "Deck", True), ("stays", "s", 2, "Lift", False),
        ("stays", "t", 0, "Wifi", False), ("twiddy", "3", 0, "Pool", True),
    ]


def test_images_of_every_source(spark):
    some = {
        s: details(spark, s, {"listing_id": 4 if s in (fv.SURFORSOUND, fv.TWIDDY) else "4", "image_urls": [f"u/{s}", "v"]})
        for s in fv.SOURCES
    }
    assert set(SHAPES["images"]) == set(fv.SOURCES)
    assert typed(child_table(some, "images"), "images") == sorted(
        (s, "4", i, u) for s in fv.SOURCES for i, u in enumerate([f"u/{s}", "v"])
    )


def test_tables_written_and_read(spark, tmp_path):
    some = {
        fv.SURFORSOUND: details(spark, fv.SURFORSOUND, {
            "listing_id": 5, "amenities": ["Pool"], "image_urls": ["a"],
            "weekly_availabilities": [("2026-07-04", 900.0, "$900", None, False)]}),
        fv.CREXI: details(spark, fv.CREXI, {"listing_id": "c", "image_urls": ["b", "c"]}),
    }
    tables = child_tables(some)
    assert sorted(tables) == ["amenities", "images", "weekly_rates"]
    write_children(tables, str(tmp_path))
    for name, rows in tables.items():
        assert typed(read_children(spark, str(tmp_path), name), name) == typed(rows, name)
    one = read_children(spark, str(tmp_path), "images").filter("source = 'crexi'")
    assert one.count() == 2 and all("source=crexi" in f for f in {r[0] for r in one.selectExpr("input_file_name()").collect()})
    with pytest.raises(ValueError, match="no source"):
        child_table({fv.CREXI: some[fv.CREXI]}, "weekly_rates")
