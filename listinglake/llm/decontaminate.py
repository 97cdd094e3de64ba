"""Benchmark decontamination: documents are scanned for the word windows of test items.

Items and documents are normalised alike: A-Z in lower case, words are what stands between
ASCII characters other than letters and digits.  An item's windows are its runs of N
words, or all its words if it has fewer.  A document's windows of the same lengths are
hashed once, from the hashes of their words; hashes meet in a join, and a hit is
confirmed by the window's words themselves.  A document word inside any hit is marked.

The windows of the benchmark are broadcast when their number is at most BROADCAST_WINDOWS
(a bound on their size); a larger benchmark is joined by shuffle, with the same result.
Only DataFrame functions are used.  The scan leaves one row per document and one per
hit, before anything is shuffled.

Results for odd input: null or empty texts have no words and are clean; items without
words, or null, are in no document; items with the same windows are all reported; items
that repeat an id are one item; documents that repeat are judged each; rows without id are
kept; own columns replace those of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.llm.common import lower_ascii, table, unused

WINDOW = 10
# 400,000 windows of about 100 bytes are 40 MB.
BROADCAST_WINDOWS = 400_000

# What separates words once A-Z are lower case: all of ASCII but digits and a-z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same in a text as it stands.
RAW = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"


def words(text: Column) -> Column:
    """The normalised words of a text; none for a null."""
    split = F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.array_remove(split, "")


def _items(array: str, size: int, start: str = "0") -> str:
    return ", ".join(f"{array}[{start} + {j}]" for j in range(size))


def _hash_windows(size: int) -> str:
    """SQL: the hash of the ``size`` words from each word on, as an array."""
    return (
        f"case when size(hashes) >= {size} then transform("
        f"sequence(0, size(hashes) - {size}), i -> xxhash64({_items('hashes', size, 'i')})) "
        "else cast(array() as array<bigint>) end"
    )


def item_windows(
    benchmark: DataFrame, n: int = WINDOW, id_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """(size, hash, content, items): the distinct windows of the benchmark."""
    rows = benchmark.select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("words"))
    size = F.least(F.lit(n), F.size("words"))
    return (
        rows.where("size(words) > 0 and item is not null")
        .withColumn("size", size)
        .select(
            "item", "size",
            F.explode(
                F.expr(
                    "transform(sequence(0, size(words) - size), i -> slice(words, i + 1, size))"
                )
            ).alias("part"),
        )
        .select(
            "item", "size",
            F.array_join("part", " ").alias("content"),
            F.transform("part", lambda w: F.xxhash64(w)).alias("hashes"),
        )
        .groupBy("size", "content", "hashes")
        .agg(F.collect_set(F.col("item")).alias("items"))
    )


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, print, times, n_words, hits): a row per distinct (id, text).

    ``hits`` are (start, size, items) by place, counted in words; ``times`` is the number
    of equal rows.
    """
    windows = item_windows(benchmark, n)
    # Lengths of windows: at most n numbers, and the count that allows a broadcast.
    facts = windows.groupBy("size").count().collect()
    sizes = sorted(r["size"] for r in facts)
    known = windows.select(
        F.col("size").alias("w_size"),
        F.coalesce(
            *[
                F.when(
                    F.col("size") == s, F.expr(f"xxhash64({_items('hashes', s)})")
                )
                for s in sizes
            ],
            F.lit(None).cast("long"),
        ).alias("w_hash"),
        "content",
        "items",
    )
    if sum(r["count"] for r in facts) <= BROADCAST_WINDOWS:
        known = F.broadcast(known)

    rows = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("print"),
        words(F.col(text_col)).alias("words"),
    )
    hashed = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    # One entry per window, and one per document with its number of words (size 0).
    lists = ["named_struct('size', 0, 'hashes', array(cast(size(hashes) as bigint)))"]
    lists += [f"named_struct('size', {s}, 'hashes', {_hash_windows(s)})" for s in sizes]
    scanned = hashed.select(
        "id", "print", "words", F.explode(F.expr(f"array({', '.join(lists)})")).alias("w")
    ).select("id", "print", "words", "w.size", F.posexplode("w.hashes").alias("start", "hash"))
    match = (F.col("hash") == F.col("w_hash")) & (F.col("size") == F.col("w_size"))
    hit = scanned.join(known, match, "left").where(
        "size = 0 or array_join(slice(words, start + 1, size), ' ') = content"
    )
    at = F.when(F.col("size") > 0, F.struct("start", "size", "items"))
    return hit.groupBy("id", "print").agg(
        F.count_if(F.col("size") == 0).alias("times"),
        F.max(F.when(F.col("size") == 0, F.col("hash"))).alias("n_words"),
        F.array_sort(F.collect_set(at)).alias("hits"),
    )


def _hit_words() -> Column:
    """Places of the words inside any hit."""
    return F.expr(
        "array_distinct(flatten(transform(hits, h -> sequence(h.start, h.start + h.size - 1))))"
    )


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """A row per document: doc_id, n_words, n_hit, n_items, items, contaminated."""
    return (
        find_hits(docs, benchmark, n)
        .withColumn("n_hit", F.size(_hit_words()).cast("long"))
        .withColumn("items", F.expr("array_distinct(flatten(hits.items))"))
        .select(
            F.explode(F.expr("array_repeat(id, cast(times as int))")).alias("doc_id"),
            "n_words",
            "n_hit",
            F.size("items").cast("long").alias("n_items"),
            "items",
            (F.col("n_hit") > 0).alias("contaminated"),
        )
    )


def remove_hits(
    docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, text_col: str = "text"
) -> DataFrame:
    """``docs`` without the words of benchmark passages; clean texts stay byte for byte.

    A removed word takes the separators behind it along.
    """
    id_col, print_col, at_col = unused(docs, "_id", "_print", "_at")
    hit = (
        find_hits(docs, benchmark, n, text_col=text_col)
        .where("size(hits) > 0")
        .select(
            F.col("id").alias(id_col), F.col("print").alias(print_col), _hit_words().alias(at_col)
        )
    )
    on = F.col("doc_id").eqNullSafe(F.col(id_col)) & (F.xxhash64(text_col) == F.col(print_col))
    text = F.col(text_col)
    lead = F.regexp_extract(text, rf"\A[{RAW}]*", 0)
    parts = F.regexp_extract_all(text, F.lit(f"[^{RAW}]+[{RAW}]*"), F.lit(0))

    def kept(all_parts: Column) -> Column:
        # The places that stay come from a hash set, so long texts with many hits are linear.
        places = F.array_except(F.sequence(F.lit(0), F.size(all_parts) - 1), F.col(at_col))
        return F.transform(places, lambda i: F.get(all_parts, i))

    # Bound by an outer lambda, the parts are cut once a text and not once a word.
    cut = F.concat(lead, F.array_join(F.flatten(F.transform(F.array(parts), kept)), ""))
    return docs.join(hit, on, "left").select(
        *[
            F.when(F.col(at_col).isNotNull(), cut).otherwise(text).alias(c) if c == text_col
            else docs[c]
            for c in docs.columns
        ]
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return contamination(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(ids, 256).alias("items_sha256"),
        "contaminated",
    )


_WORDS = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), "
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w != '')"
)

OP7_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS size, w[i : i + least(10, len(w)) - 1] AS part
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
          FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT doc_id, size, i, w[i : i + size - 1] AS part
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes)
),
hits AS (SELECT doc_id, i, p.size, item_id FROM places p JOIN windows USING (size, part)),
hit_words AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id
),
hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
