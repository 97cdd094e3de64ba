"""Listings, rates and requests derived from the given tables.

Each derivation exists twice: as a DataFrame, and as SQL text for the check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, if there is one, the SQL with the same result."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- offers: one line item is one offer of a part as a stay -------------------

# Identifies an offer within (check_in, listing).
OFFER_ORDER = ["page", "l_orderkey", "l_suppkey", "total", "nights"]


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    size = F.col("p_size")
    check_in = F.col("l_shipdate").cast("date")
    nights = F.col("l_quantity").cast("int")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("l_partkey").cast("string").alias("listing_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("property_type"),
            F.lower(F.replace("n_name", F.lit("_"), F.lit("-"))).alias("town"),
            F.when(size % 11 != 0, size % 12).alias("bedrooms"),
            (size % 9).cast("double").alias("bathrooms"),
            F.when(F.col("l_partkey") % 4 != 0, 3 + F.col("l_partkey") % 9 * 0.25).alias(
                "rating"
            ),
            F.when(F.col("l_partkey") % 4 != 0, (F.col("l_partkey") % 40).cast("int")).alias(
                "review_count"
            ),
            F.date_format(check_in, "yyyy-MM-dd").alias("check_in"),
            nights.alias("nights"),
            F.date_format(F.date_add(check_in, nights), "yyyy-MM-dd").alias("check_out"),
            F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice")).alias("total_price"),
            F.concat(F.lit("https://h/rooms/"), F.col("l_partkey").cast("string")).alias("url"),
            F.col("l_linenumber").alias("page"),
            "l_orderkey",
            "l_suppkey",
            F.col("l_extendedprice").alias("total"),
        )
    )


OFFERS = """
offers AS (
  SELECT CAST(l_partkey AS VARCHAR) AS listing_id, p_name AS name, p_type AS property_type,
    lower(replace(n_name, '_', '-')) AS town,
    CASE WHEN p_size % 11 <> 0 THEN p_size % 12 END AS bedrooms,
    CAST(p_size % 9 AS DOUBLE) AS bathrooms,
    CASE WHEN l_partkey % 4 <> 0 THEN 3 + (l_partkey % 9) * CAST(0.25 AS DOUBLE) END AS rating,
    CASE WHEN l_partkey % 4 <> 0 THEN CAST(l_partkey % 40 AS INTEGER) END AS review_count,
    strftime(l_shipdate, '%Y-%m-%d') AS check_in,
    CAST(l_quantity AS INTEGER) AS nights,
    strftime(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER), '%Y-%m-%d') AS check_out,
    CASE WHEN l_linenumber <> 7 THEN l_extendedprice END AS total_price,
    'https://h/rooms/' || l_partkey AS url,
    l_linenumber AS page, l_orderkey, l_suppkey, l_extendedprice AS total
  FROM lineitem JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
)"""

OFFER_COLUMNS = (
    "listing_id, name, town, bedrooms, check_in, nights, total_price, page, l_orderkey, "
    "l_suppkey, total"
)


def offer_columns(df: DataFrame) -> DataFrame:
    return df.select(*OFFER_COLUMNS.split(", "))


# First offer per (check_in, listing).
FIRST_OFFERS = """
first_offers AS (
  SELECT * FROM offers QUALIFY row_number() OVER (
    PARTITION BY check_in, listing_id ORDER BY page, l_orderkey, l_suppkey, total, nights) = 1
)"""

# ---- rates: one line item is one arrival week of a part ------------------------

RATE_ORDER = ["l_linenumber", "l_orderkey", "l_suppkey", "price"]


def rates(spark: SparkSession, sf_dir: str, week: str | None = None) -> DataFrame:
    """Rates of all weeks, or of one; the week then reaches the scan as a range."""
    line = table(spark, sf_dir, "lineitem")
    if week:
        start = F.lit(week).cast("timestamp")
        end = F.lit(week).cast("date") + F.expr("INTERVAL 1 DAY")
        line = line.filter(
            (F.col("l_shipdate") >= start) & (F.col("l_shipdate") < end.cast("timestamp"))
        )
    price = F.col("l_extendedprice")
    day = F.col("l_shipdate").cast("date")
    return line.select(
        F.col("l_partkey").cast("string").alias("listing_id"),
        F.date_format(day, "yyyy-MM-dd").alias("arrive"),
        F.date_format(day, "M/d/yyyy").alias("arrival_date"),
        F.when(F.col("l_linenumber") != 7, price).alias("weekly_rate"),
        F.when(
            F.col("l_linenumber") != 7, F.concat(F.lit("$"), F.format_number(price, 2))
        ).alias("rate_display"),
        (F.col("l_returnflag") != "R").alias("is_available"),
        F.col("l_linestatus").alias("book_type"),
        "l_linenumber",
        "l_orderkey",
        "l_suppkey",
        price.alias("price"),
    )


RATES = """
rates AS (
  SELECT CAST(l_partkey AS VARCHAR) AS listing_id, CAST(l_shipdate AS DATE) AS arrive,
    CASE WHEN l_linenumber <> 7 THEN l_extendedprice END AS weekly_rate,
    l_returnflag <> 'R' AS is_available, l_linestatus AS book_type,
    l_linenumber, l_orderkey, l_suppkey, l_extendedprice AS price
  FROM lineitem
)"""


def part_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("listing_id"),
        F.col("p_name").alias("name"),
        F.lower("p_type").alias("town"),
        F.when(size % 11 != 0, size % 12).alias("bedrooms"),
        F.concat(F.lit("https://h/"), F.col("p_partkey").cast("string")).alias("url"),
        F.lit(1).alias("page"),
        F.col("p_partkey").alias("pos"),
    )


def part_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("listing_id"),
        (size + 2).alias("sleeps"),
        (size % 9).alias("bathrooms_full"),
        (size % 3).alias("bathrooms_half"),
    )


PART_LISTINGS = """
listings AS (
  SELECT CAST(p_partkey AS VARCHAR) AS listing_id, p_name AS name, lower(p_type) AS town,
    CASE WHEN p_size % 11 <> 0 THEN p_size % 12 END AS bedrooms,
    'https://h/' || p_partkey AS url, p_size + 2 AS sleeps, p_size % 9 AS bathrooms_full,
    p_size % 3 AS bathrooms_half
  FROM part
)"""


# ---- homes: up to three homes per order or part, inside one landed response -----

_KEYS = {
    "orders": ("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus"),
    "part": ("p_partkey", "p_name", "p_retailprice", "p_type"),
}


def keyed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """key, label, money, kind of a table; one row becomes one response.

    A body is many times larger than the row it is built from, so splits sized for
    the rows would make tasks too large: spread the narrow rows first.
    """
    key, label, money, kind = _KEYS[name]
    rows = table(spark, sf_dir, name).select(
        F.col(key).cast("bigint").alias("key"),
        F.col(label).alias("label"),
        F.col(money).alias("money"),
        F.col(kind).alias("kind_text"),
    )
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "key")


def home_list(make: Callable[[Column], Column]) -> Column:
    """List of 1 to 3 homes of a row; ``make`` gets the home's id."""
    count = (F.col("key") % 3).cast("int")
    return F.transform(
        F.sequence(F.lit(0), count), lambda i: make(F.col("key") * 3 + i)
    )


def homes_sql(name: str) -> str:
    key, label, money, kind = _KEYS[name]
    return f"""
homes AS (
  SELECT CAST(k * 3 + i AS BIGINT) AS id, k, CAST(i AS INTEGER) AS pos, label, money, kind_text
  FROM (SELECT {key} AS k, {label} AS label, {money} AS money, {kind} AS kind_text FROM {name}),
    (SELECT unnest(range(3)) AS i)
  WHERE i <= k % 3
)"""


def responses(
    rows: DataFrame,
    source: str,
    kind: str,
    body: Column,
    entity_id: Column | None = None,
    params: dict[str, Column] | None = None,
    check_in: Column | None = None,
    nights: Column | None = None,
    page: Column | None = None,
    http_status: Column | None = None,
) -> DataFrame:
    """Landed responses, one per row, with the given body."""

    def typed(c: Column | None, kind_: str) -> Column:
        return (F.lit(None) if c is None else c).cast(kind_)

    pairs = [x for k, v in (params or {}).items() for x in (F.lit(k), v)]
    return rows.select(
        F.lit(source).alias("source"),
        F.lit(kind).alias("kind"),
        typed(entity_id, "string").alias("entity_id"),
        typed(F.create_map(*pairs) if pairs else None, "map<string,string>").alias("params"),
        typed(check_in, "date").alias("check_in"),
        typed(nights, "int").alias("nights"),
        F.coalesce(typed(page, "int"), F.lit(1)).alias("page"),
        F.coalesce(typed(http_status, "int"), F.lit(200)).alias("http_status"),
        F.lit(None).cast("timestamp").alias("fetched_at"),
        body.alias("body"),
    )


def joined(*columns: str) -> list[Column]:
    """List columns as text, so both engines compare them the same way."""
    return [F.array_join(c, "|").alias(c) for c in columns]
