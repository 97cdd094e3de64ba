"""Which of many codes a text ends with: a suffix index.

Read backwards, the codes that a text ends with are its prefixes.  Among the sorted
reversed codes, every one that is a prefix of a text is also a prefix of the last code
that does not come after the text.  So one place in the order, and the chain of codes that
are prefixes of the code there, answer for all lengths at once: each text is looked at a
single time, whatever the codes' lengths.
"""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from listinglake.session import settled

# Codes up to which the index is sent to the tasks; a few MB.  Beyond, texts and codes are
# merged by ranges.
SENT_CODES = 100_000
# And the characters they may have in all.
SENT_CHARS = 8 << 20


class SuffixIndex:
    """The sorted reversed codes, each with the nearest code that is a prefix of it."""

    def __init__(self, codes: list[str]):
        self.sorted = sorted({c[::-1] for c in codes if c})
        self.before: list[int] = []
        open_: list[int] = []
        for i, code in enumerate(self.sorted):
            while open_ and not code.startswith(self.sorted[open_[-1]]):
                open_.pop()
            self.before.append(open_[-1] if open_ else -1)
            open_.append(i)

    def ends_of(self, text: str) -> list[str]:
        """All codes that ``text`` ends with, longest first."""
        back = text[::-1]
        at = bisect_right(self.sorted, back) - 1
        found = []
        while at >= 0:
            if back.startswith(self.sorted[at]):
                found.append(self.sorted[at][::-1])
            at = self.before[at]
        return found


def with_suffixes(
    df: DataFrame, text: str, codes: DataFrame, code: str = "code", into: str = "code",
    sent_codes: int = SENT_CODES,
) -> DataFrame:
    """A row of ``df`` for each code that its text ends with; the rest drop out.

    ``codes`` are distinct texts; '' and null match nothing.  Few codes are sent to the
    tasks as an index, so no row of ``df`` is shuffled; many are merged with the texts
    by ranges of both.
    """
    known = settled(codes.select(F.col(code).alias("c")).where("c != ''"), "codes")
    size = known.agg(F.count("c").alias("n"), F.sum(F.length("c")).alias("chars")).first()
    if size["n"] <= sent_codes and (size["chars"] or 0) <= SENT_CHARS:
        return _by_index(df, text, [r["c"] for r in known.collect()], into)
    return _by_ranges(df, text, known, into)


def _by_index(df: DataFrame, text: str, codes: list[str], into: str) -> DataFrame:
    sent = df.sparkSession.sparkContext.broadcast(codes)
    held: list[SuffixIndex] = []

    @F.pandas_udf("array<string>")
    def ends(texts: pd.Series) -> pd.Series:
        if not held:
            held.append(SuffixIndex(sent.value))
        return pd.Series([held[0].ends_of(t) if t else [] for t in texts], dtype=object)

    return df.withColumn(into, F.explode(ends(F.col(text))))


def _chains(known: DataFrame) -> DataFrame:
    """(back, chain): every reversed code with all codes that are prefixes of it."""
    back = known.select(F.reverse("c").alias("back"))
    lengths = known.agg(F.array_sort(F.collect_set(F.length("c"))).alias("lengths"))
    cut = back.crossJoin(F.broadcast(lengths)).select(  # one row of lengths
        "back", F.explode(F.filter("lengths", lambda n: n <= F.length("back"))).alias("n")
    )
    cut = cut.select("back", F.expr("substring(back, 1, n)").alias("start"))
    starts = back.withColumnRenamed("back", "start")
    return cut.join(starts, "start").groupBy("back").agg(F.collect_list("start").alias("chain"))


def _by_ranges(df: DataFrame, text: str, known: DataFrame, into: str) -> DataFrame:
    names = df.columns
    texts = df.select(
        F.reverse(text).alias("back"),
        F.lit(1).alias("kind"),
        F.xxhash64(*names).alias("spread"),  # a text that stands there often is dealt to many
        F.lit(None).cast("array<string>").alias("chain"),
        F.struct(*names).alias("row"),
    )
    codes = _chains(known).select(
        "back", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("spread"), "chain"
    )
    both = texts.where("back != ''").unionByName(codes, allowMissingColumns=True)
    dealt = settled(
        both.repartitionByRange("back", "kind", "spread").withColumn("range", F.spark_partition_id()),
        "suffixes",
    )
    # A row per range: the last chain before it.
    ends = dealt.groupBy("range").agg(F.max_by("chain", F.when(F.col("kind") == 0, F.col("back"))).alias("last"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select("range", F.last("last", ignorenulls=True).over(before).alias("carried"))
    up_to = W.partitionBy("range").orderBy("back", "kind", "spread").rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    chained = dealt.withColumn("chain", F.last("chain", ignorenulls=True).over(up_to))
    chained = chained.where("kind = 1").join(F.broadcast(carried), "range")
    mine: Column = F.filter(
        F.coalesce("chain", "carried"), lambda c: F.startswith(F.col("back"), c)
    )
    matched = chained.select("row", F.explode(mine).alias("end"))
    return matched.select(
        *[F.col(f"row.{n}").alias(n) for n in names if n != into], F.reverse("end").alias(into)
    )
