"""The landing folder, laid out so that a search opens what was asked for only.

Folders are ``source / kind / area / check_in / stretch``.  ``area`` is the request key: the
town, village or ZIP that a search asked for, so it is known before a body is parsed.
``check_in`` is the asked arrival date.  ``stretch`` gathers pages in ranges that double
(1, 2-3, 4-7, ...), which lets a search read on in page order and stop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake import schemas
from listinglake.functions.text import strip
from listinglake.sources.landing import CHOSEN, PLACE, place
from listinglake.sources.sinks import deal_to_folders

FOLDERS = ["source", "kind", "area", "check_in", "stretch"]

# The request parameter that names the area of a search.
AREA_PARAM = {
    fv.CAROLINADESIGNS: "town",
    fv.CREXI: "query",
    fv.REDFIN: "zip_code",
    fv.SUNREALTY: "town",
    fv.SURFORSOUND: "villages",
    fv.TWIDDY: "town",
}
# Free text has no end of values; such areas share so many folders.
HASHED = {fv.CREXI: 256}


def area_key(source: str, area: Column) -> Column:
    """The folder of an area, as asked for in a request or by a search."""
    key = F.lower(strip(area))
    if source in HASHED:
        return F.concat(F.lit("h"), (F.crc32(key.cast("binary")) % HASHED[source]).cast("string"))
    return key


def asked_area() -> Column:
    """The folder of a landed response, from its request parameters."""
    out = F.lit(None).cast("string")
    for source, name in AREA_PARAM.items():
        is_source = (F.col("source") == source) & (F.col("kind") == "search")
        out = F.when(is_source, area_key(source, F.col("params")[name])).otherwise(out)
    return out


def stretch_of(page: Column) -> Column:
    """0 for page 1 (and below), 1 for 2-3, 2 for 4-7: the binary digits behind the first."""
    return F.length(F.bin(F.greatest(F.coalesce(page, F.lit(1)), F.lit(1)))) - 1


def write_landing(responses: DataFrame, path: str, mode: str = "append") -> None:
    rows = responses.drop(PLACE, CHOSEN)
    laid_out = rows.withColumns({"area": asked_area(), "stretch": stretch_of(F.col("page"))})
    dealt = deal_to_folders(laid_out, FOLDERS)
    dealt.sortWithinPartitions(*FOLDERS, "page").write.mode(mode).partitionBy(*FOLDERS).parquet(path)


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    schema = f"{schemas.RESPONSES}, area STRING, stretch INT"
    return spark.read.schema(schema).parquet(path).select("*", place())


def asked(
    landing: DataFrame,
    source: str,
    kind: str = "search",
    area: str | None = None,
    check_in: str | None = None,
) -> DataFrame:
    """What was landed for one request key; all tests are on folders, none on a body.

    ``check_in`` '' stands for requests without a date, None for any.
    """
    rows = landing.filter((F.col("source") == source) & (F.col("kind") == kind))
    if area is not None:
        rows = rows.filter(F.col("area") == area_key(source, F.lit(area)))
    if check_in == "":
        rows = rows.filter(F.col("check_in").isNull())
    elif check_in is not None:
        rows = rows.filter(F.col("check_in") == F.lit(check_in).cast("date"))
    return rows


def stretches(rows: DataFrame) -> list[int]:
    """The stretches that have pages, in order.

    Reads folder names and row counts only; there are as many as the highest page
    number has binary digits.
    """
    found = rows.select("stretch").distinct().orderBy("stretch").collect()
    return [r["stretch"] for r in found]
