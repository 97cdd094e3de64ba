"""Result sinks.  Rows are written by the tasks that hold them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_report(
    tables: dict[str, DataFrame], path: str, fmt: str = "parquet", mode: str = "overwrite"
) -> None:
    """One folder per report table; csv gets a header."""
    for name, df in tables.items():
        writer = df.write.mode(mode)
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(f"{path}/{name}")


def deal_to_folders(df: DataFrame, folders: list[str]) -> DataFrame:
    """Rows dealt to writing tasks by folder, each folder to as many as its size asks for.

    Run-time re-planning measures the shuffle: small folders share a task, and one that
    holds most of the rows is split among tasks in proportion to its bytes
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes`` each).  No count is guessed, and a
    folder gets no more files than it has tasks.
    """
    return df.hint("rebalance", *folders)


def write_silver(
    df: DataFrame, path: str, source: str | None = None, mode: str = "append"
) -> None:
    """Normalised rows, laid out so that source (and town) filters prune folders."""
    if source is not None:
        df = df.withColumn("source", F.lit(source))
    keys = [c for c in ("source", "town") if c in df.columns]
    if keys:
        df = deal_to_folders(df, keys)
    df.write.mode(mode).partitionBy(*keys).parquet(path)
