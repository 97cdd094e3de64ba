"""Continuous normalisation of newly landed responses.

The normalisers are stateless, so the batch code runs unchanged on a stream.  A
details job that joins side lists needs both sides at once and stays a batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from listinglake import schemas
from listinglake.plans.normalize import SOURCES
from listinglake.session import checkpoint_dir


def stream_responses(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schemas.RESPONSES).format(fmt).load(path)


def stream_listings(responses: DataFrame, source: str) -> DataFrame:
    module = SOURCES[source]
    return module.listings(module.search_payloads(responses))


def write_listings(
    listings: DataFrame, path: str, name: str, available_now: bool = True
) -> StreamingQuery:
    """Append the rows to a parquet table.

    Progress is kept below the session's shared checkpoint folder under ``name``,
    so a restarted job neither loses nor repeats a file.
    """
    progress = f"{checkpoint_dir(listings.sparkSession)}/streams/{name}"
    writer = (
        listings.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", progress)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
