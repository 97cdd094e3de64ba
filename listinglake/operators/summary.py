"""Counts and field completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def result_summary(rows: DataFrame, area: str, label: str = "search_area") -> DataFrame:
    """One row: the area label and how many rows came back."""
    return rows.agg(
        F.lit(area).alias(label), F.count("*").cast("int").alias("total_returned")
    )


def missing(name: str, schema: StructType) -> Column:
    """Null or '' is missing; 0 and false are values."""
    c = F.col(name)
    if isinstance(schema[name].dataType, StringType):
        return c.isNull() | (c == "")
    return c.isNull()


def missing_fields(df: DataFrame, fields: list[str]) -> Column:
    """Names of the required fields that a row lacks, in the given order."""
    names = [F.when(missing(f, df.schema), F.lit(f)) for f in fields]
    return F.filter(F.array(*names), lambda n: n.isNotNull())


def population(df: DataFrame, fields: list[str]) -> DataFrame:
    """Row count, and how many rows have each field filled."""
    return df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(~missing(f, df.schema)).alias(f"{f}_filled") for f in fields],
    )


def town_funnel(
    rows: DataFrame, has_week: Column, in_budget: Column, town: str = "town"
) -> DataFrame:
    """Fetched -> with the target week -> in budget, per town and overall.

    The grouping is on two levels in one pass; the overall row has a null town.
    """
    return rows.rollup(town).agg(
        F.count("*").alias("fetched"),
        F.count_if(has_week).alias("with_week"),
        F.count_if(in_budget).alias("in_budget"),
    )


def status_tally(results: DataFrame) -> DataFrame:
    return results.agg(
        *[
            F.count_if(F.col("status") == s).alias(s.lower())
            for s in ("PASS", "WARN", "FAIL")
        ]
    )
