"""Responses -> typed tables, for every source.

``SOURCES`` is the one place that knows which module parses what.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from listinglake import fixed_values as fv
from listinglake.operators.rates import child_rows
from listinglake.operators.union import union_all
from listinglake.sources import (
    carolinadesigns, churchrealty, crexi, redfin, stays, sunrealty, surforsound, twiddy,
)
from listinglake.sources.landing import quarantine

SOURCES = {
    fv.STAYS: stays,
    fv.CAROLINADESIGNS: carolinadesigns,
    fv.CHURCHREALTY: churchrealty,
    fv.CREXI: crexi,
    fv.REDFIN: redfin,
    fv.SUNREALTY: sunrealty,
    fv.SURFORSOUND: surforsound,
    fv.TWIDDY: twiddy,
}

# List columns of a details table that also make sense as child tables.
CHILD_TABLES = {
    fv.STAYS: ["amenities", "unavailable_amenities", "image_urls"],
    fv.CAROLINADESIGNS: ["amenities", "image_urls", "weekly_rates"],
    fv.CHURCHREALTY: ["image_urls"],
    fv.CREXI: ["image_urls", "broker_names"],
    fv.REDFIN: ["image_urls"],
    fv.SUNREALTY: ["amenities", "image_urls", "availability_windows"],
    fv.SURFORSOUND: ["amenities", "image_urls", "weekly_availabilities"],
    fv.TWIDDY: ["amenities", "image_urls", "weekly_rates"],
}


@dataclass(frozen=True)
class Tables:
    rows: DataFrame
    quarantine: DataFrame


def search_tables(responses: DataFrame, source: str) -> Tables:
    module = SOURCES[source]
    payloads = module.search_payloads(responses)
    return Tables(module.listings(payloads), quarantine(payloads))


# Sources that are told which columns a job wants; of the others, Spark itself parses no field
# that is not asked for.
TOLD_COLUMNS = {fv.STAYS}


def detail_tables(
    responses: DataFrame, source: str, columns: list[str] | None = None
) -> Tables:
    """With ``columns``, the rows need have no more than these and ``listing_id``."""
    module = SOURCES[source]
    told = {"columns": columns} if columns and source in TOLD_COLUMNS else {}
    payloads = module.detail_payloads(responses, **told)
    return Tables(module.details(payloads, **told), quarantine(payloads))


def child_tables(details: DataFrame, source: str) -> dict[str, DataFrame]:
    return {c: child_rows(details, c) for c in CHILD_TABLES[source]}


def all_quarantined(responses: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """Drifted responses of every source, searches and details."""
    names = sources or fv.SOURCES
    return union_all(
        [t(responses, s).quarantine for s in names for t in (search_tables, detail_tables)]
    )
