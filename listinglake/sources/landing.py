"""Landed responses: reading, status rules, and the shape of parsed payloads.

A parsed payload table has one row per response: the request columns, ``drift``
(null when the response had the expected shape) and ``items`` (the raw records).
Rows and quarantine both come from it, so a job that wants both writes or caches
the payload table once instead of parsing twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from listinglake import fixed_values as fv
from listinglake import schemas
from listinglake.session import settled

REQUEST_COLUMNS = [
    "source", "kind", "entity_id", "params", "check_in", "nights", "page", "http_status",
    "fetch",
]


def read_responses(
    spark: SparkSession,
    path: str,
    source: str | None = None,
    kind: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Landed responses of one source and kind.

    The landing folder is partitioned by ``source`` and ``kind``, so both filters
    prune directories before any body is read.
    """
    df = spark.read.schema(schemas.RESPONSES).format(fmt).load(path)
    if fmt == "parquet":
        df = df.select("*", place())
    if source:
        df = df.filter(F.col("source") == source)
    if kind:
        df = df.filter(F.col("kind") == kind)
    return df


def read_pages(spark: SparkSession, path: str, source: str, kind: str) -> DataFrame:
    """Landed page files, one response per file."""
    files = spark.read.text(path, wholetext=True)
    return files.select(
        F.lit(source).alias("source"),
        F.lit(kind).alias("kind"),
        F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]*)?$", 1).alias("entity_id"),
        F.lit(None).cast("map<string,string>").alias("params"),
        F.lit(None).cast("date").alias("check_in"),
        F.lit(None).cast("int").alias("nights"),
        F.lit(1).alias("page"),
        F.lit(200).alias("http_status"),
        F.lit(None).cast("timestamp").alias("fetched_at"),
        F.col("value").alias("body"),
    )


def pick(responses: DataFrame, source: str, kind: str) -> DataFrame:
    """Responses of one kind, with what orders the fetches of one request.

    Where the place in the landing folder is known, old fetches go here, before any body
    is read.
    """
    df = responses.filter((F.col("source") == source) & (F.col("kind") == kind))
    if PLACE in df.columns and not df.isStreaming:
        df = newest_landed(df, kind)
    if CHOSEN in df.columns:
        return df.withColumn("fetch", F.struct(CHOSEN))
    return df.withColumn("fetch", F.struct(*fetch_order(kind)))


# Where a response lies in the landing folder, and that it is the newest of its request.
PLACE, CHOSEN = "landed", "chosen"


def place() -> Column:
    """The file and row of a response; known to readers of Parquet files only."""
    return F.struct("_metadata.file_path", "_metadata.row_index").alias(PLACE)


def newest_landed(df: DataFrame, kind: str) -> DataFrame:
    """``df`` without the older fetches of requests that landed several times.

    The choice is made on request columns, status, time and the row's place alone, so the
    shuffle carries no body, and an old fetch is never parsed.  Most requests land once:
    they are counted by hashes first, and where none came twice nothing else is done.  Old
    fetches are told to the tasks as one bit per landed row, by file, so that no response is
    shuffled however many are old.  Equal times are told apart by the place.
    """
    request = F.struct(
        "entity_id", F.to_json(F.array_sort(F.map_entries("params"))).alias("asked"),
        "check_in", "nights", "page",
    )
    # Equal hashes of different requests do no harm: the requests themselves follow.
    narrow = df.select(F.xxhash64(request).alias("_hash"), request.alias("_request"), *_order(kind))
    again = narrow.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    again = settled(again.filter("_n > 1").select("_hash"), "refetched")
    many = again.count()
    if many:
        if many <= SENT_REQUESTS:
            narrow = narrow.join(F.broadcast(again), "_hash", "left_semi")
        text = F.to_json("_request", {"ignoreNullFields": "false"}).alias("_request")
        best = narrow.groupBy("_hash", text).agg(F.max("_fetch").alias("_fetch"))
        old = settled(_old_rows(narrow, best), "old-fetches")
        at = F.col(PLACE)["row_index"]
        is_old = (
            (F.col(PLACE)["file_path"] == old["file"])
            & (F.floor(at / BLOCK_ROWS) == old["block"])
            & (F.getbit(F.get(old["words"], (at % BLOCK_ROWS / 64).cast("int")), at % 64) == 1)
        )
        # Beyond that many the planner goes by the measured size.
        df = df.join(F.broadcast(old) if old.count() <= SENT_BLOCKS else old, is_old, "left_anti")
    return df.drop(PLACE).withColumn(CHOSEN, F.lit(True))


# Rows of a file whose bits are one block, 4 KB, and how many blocks are sent to the tasks:
# 128 MB, which is a billion landed rows of one source and kind.
BLOCK_ROWS, SENT_BLOCKS = 1 << 15, 1 << 15


def _order(kind: str) -> list[Column]:
    usable, *_ = fetch_order(kind)
    return [F.struct(usable, "fetched_at", PLACE).alias("_fetch")]


def _old_rows(fetches: DataFrame, best: DataFrame) -> DataFrame:
    """A bit for each row of ``fetches`` that is not among ``best``, by file and block."""
    rows = fetches.select("_fetch", F.lit(False).alias("best")).unionByName(
        best.select("_fetch", F.lit(True).alias("best"))
    )
    at = F.col(f"_fetch.{PLACE}.row_index")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % 64).cast("int"))
    words = (
        rows.select(
            F.col(f"_fetch.{PLACE}.file_path").alias("file"),
            F.floor(at / BLOCK_ROWS).alias("block"),
            (at % BLOCK_ROWS / 64).cast("int").alias("word"),
            F.when(~F.col("best"), bit).otherwise(0).alias("landed"),
            F.when(F.col("best"), bit).otherwise(0).alias("kept"),
        )
        .groupBy("file", "block", "word")
        .agg(F.bit_or("landed").alias("landed"), F.bit_or("kept").alias("kept"))
        .select("file", "block", "word", F.col("landed").bitwiseAND(F.bitwise_not("kept")).alias("old"))
    )
    blocks = words.filter("old <> 0").groupBy("file", "block").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "old"))).alias("old"),
        F.max("word").alias("last"),
    )
    all_words = F.transform(
        F.sequence(F.lit(0), "last"), lambda i: F.coalesce(F.col("old")[i], F.lit(0).cast("bigint"))
    )
    return blocks.select("file", "block", all_words.alias("words"))


FETCH_COLUMNS = ["usable", "fetched_at", "body_hash"]


def fetch_order(kind: str | None = None) -> list[Column]:
    """Columns that order the fetches of one response; taken before the body goes.

    A usable response comes before a failed one, however new that is.  For side
    lists some bad statuses are an answer as well.
    """
    answers = F.col("http_status").isin(fv.EMPTY_STATUSES.get(kind, []))
    return [
        (ok_status() | F.coalesce(answers, F.lit(False))).alias("usable"),
        F.col("fetched_at"),
        F.xxhash64("body").alias("body_hash"),
    ]


def latest(rows: DataFrame, key: str = "entity_id") -> DataFrame:
    """Newest response per key, for rows that carry ``fetch_order()``.

    Meant for parsed rows, which are narrower than bodies.  The rank-1 filter lets
    Spark cut every key to one row per task before the shuffle, so a key that was
    fetched very often stays cheap, and joins on the key see it once.
    """
    newest = W.partitionBy(key).orderBy(
        F.col("usable").desc(), F.col("fetched_at").desc_nulls_last(), F.col("body_hash")
    )
    return (
        rows.withColumn("_rn", F.row_number().over(newest))
        .filter(F.col("_rn") == 1)
        .drop("_rn", *FETCH_COLUMNS)
    )


def ok_status() -> Column:
    return F.coalesce(F.col("http_status").between(200, 299), F.lit(True))


def usable_body() -> Column:
    """The body of a usable response; that of a failed one is not parsed, its status is its drift."""
    return F.when(ok_status(), F.col("body"))


def status_drift(*reasons: tuple[Column, str]) -> Column:
    """First failing rule as text, null when the response is usable."""
    out = F.when(
        ~ok_status(), F.concat(F.lit("HTTP status "), F.col("http_status").cast("string"))
    )
    for failing, text in reasons:
        out = out.when(failing, text)
    return out


def status_to_rows(kind: str, rows: Column) -> Column:
    """Side lists: some bad statuses mean "empty", any other bad one means unknown.

    A body that is not a list counts as empty.
    """
    empty = F.array().cast("array<string>")
    return (
        F.when(F.col("http_status").isin(fv.EMPTY_STATUSES[kind]), empty)
        .when(~ok_status(), F.lit(None))
        .otherwise(F.coalesce(rows, empty))
    )


def payload_table(
    df: DataFrame, drift: Column, items: Column, chosen: bool = False
) -> DataFrame:
    """Parsed payloads; a drifted response keeps its row but has no items.

    ``chosen``: the rows are the newest of their requests already.
    """
    payloads = df.select(
        *REQUEST_COLUMNS,
        drift.alias("drift"),
        F.when(drift.isNull(), items).alias("items"),
    )
    return payloads if chosen else newest_fetch(payloads)


# What names the fields of a response that is one record, in its payload table.
FIELD = "item_"


def record_table(
    df: DataFrame, drift: Column, fields: dict[str, Column], chosen: bool = False
) -> DataFrame:
    """Parsed payloads of responses that are one record each.

    Its fields are columns, so that a job which wants some of them parses no others; in a
    list of structs they would all be made.  They count where ``drift`` is null only.
    """
    named = [c.alias(f"{FIELD}{name}") for name, c in fields.items()]
    payloads = df.select(*REQUEST_COLUMNS, drift.alias("drift"), *named)
    return payloads if chosen else newest_fetch(payloads)


def newest_fetch(payloads: DataFrame) -> DataFrame:
    """One row per request: its newest usable response, else its newest one.

    A request is an entity or a set of parameters, with its dates and page.  Requests are
    counted first, on their own columns: parsed records are shuffled and sorted only where a
    request landed several times.  If that is so for very many, all rows are ranked.  A
    stream has no end to compare fetches over; there every response is passed on.
    """
    if payloads.isStreaming or CHOSEN in payloads.schema["fetch"].dataType.names:
        return payloads
    # Equal hashes of different requests do no harm: the rank tells them apart.
    request = F.xxhash64(*_request()).alias("_again")
    again = payloads.select(request).groupBy("_again").agg(F.count(F.lit(1)).alias("_n"))
    again = settled(again.filter("_n > 1").select("_again"), "refetched")
    many = again.count()
    if not many:
        return payloads
    if many > SENT_REQUESTS:
        return _ranked_fetches(payloads)
    again = F.broadcast(again)
    keyed = payloads.withColumn("_again", request)
    once = keyed.join(again, "_again", "left_anti").drop("_again")
    return once.unionByName(_ranked_fetches(keyed.join(again, "_again", "left_semi").drop("_again")))


# Repeated requests up to which their hashes are sent to the tasks; a few MB.
SENT_REQUESTS = 500_000


def _request() -> list[Column]:
    asked = F.to_json(F.array_sort(F.map_entries("params")))
    return [*map(F.col, ("source", "kind", "entity_id")), asked, *map(F.col, ("check_in", "nights", "page"))]


def _ranked_fetches(payloads: DataFrame) -> DataFrame:
    """The rank-1 filter cuts every request to one row per task before the shuffle.

    The hash comes first: sorts compare one number, and the request where it is equal.
    """
    newest = W.partitionBy(F.xxhash64(*_request()), *_request()).orderBy(
        F.col("fetch.usable").desc(),
        F.col("fetch.fetched_at").desc_nulls_last(),
        F.col("fetch.body_hash"),
    )
    rank = payloads.withColumn("_rn", F.row_number().over(newest))
    return rank.filter(F.col("_rn") == 1).drop("_rn")


def explode_items(payloads: DataFrame, keep: list[str] = schemas.ORDER_COLUMNS) -> DataFrame:
    """One row per raw record of the usable responses, with its position.

    With ``drift`` in ``keep``, a drifted response is one row without position and record.
    The fields of a ``record_table`` go past the explode as columns and are one again above it.
    Empty responses are dropped behind the explode.  A filter in front of it (Spark
    infers one for the inner form) would run the whole parse a second time.
    """
    drift = F.col("drift") if "drift" in keep else F.lit(None).cast("string").alias("drift")
    fields = [c for c in payloads.columns if c.startswith(FIELD)]
    items = F.when(F.col("drift").isNull(), F.array(F.lit(True))) if fields else F.col("items")
    rows = payloads.select(
        *REQUEST_COLUMNS, drift, *fields, F.posexplode_outer(items).alias("pos", "item")
    ).filter(F.col("pos").isNotNull() | F.col("drift").isNotNull())
    if not fields:
        return rows

    def of_record(c: str) -> Column:
        return F.when(F.col("pos").isNotNull(), F.col(c)) if "drift" in keep else F.col(c)

    item = F.struct(*[of_record(c).alias(c.removeprefix(FIELD)) for c in fields])
    return rows.withColumn("item", item).drop(*fields)


def known(column: str) -> Column:
    """Records need the column; drifted responses have none."""
    return F.col("drift").isNotNull() | F.col(column).isNotNull()


def quarantine(payloads: DataFrame) -> DataFrame:
    """Responses that lost the expected shape, with the reason.

    The explode keeps the filter from moving below the parse, where it would repeat
    the parse inside its condition.
    """
    return payloads.select(
        "source", "kind", "entity_id", "page", "http_status",
        F.explode_outer(F.array("drift")).alias("drift"),
    ).filter(F.col("drift").isNotNull())
