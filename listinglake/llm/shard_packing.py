"""Sharding by vector bin packing: bytes, tokens and rows of the shards balanced jointly.

Rows with equal texts are a group and go to one shard, unless the group alone holds more
than 1 / (SHARES * shards) of all bytes: such a group is dealt in SLICES pieces by row id,
else no balance could be had.  There are fewer than SHARES * shards such groups, so their
list is small whatever the input.

Each group is a vector: its shares of all bytes, tokens and rows.  Groups are placed from the
largest down, each on the shard where the dot product of its vector with what the shard
has left to its fair share is highest.  One sequence of placements would be one task, so
groups are dealt by hash into cells of about CELL_GROUPS, and each cell packs its groups onto
all shards with its own fair shares; as every cell ends balanced, so do the sums.

The law is ``bytes``: sizes near equal.  A slot is a row's place in its shard: rows
are counted per shard and slice of ids, and the offsets of the slices are summed.

Results for odd input: a null text has no bytes (size is the fixed 16) and checksum 0;
rows that repeat are placed and counted each; rows without id are kept; fewer rows than
shards leave shards empty; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listinglake.llm.common import more, settle, table

SHARDS = 40
ROW_BYTES = 16  # what a row takes besides its text
# What bytes, tokens and rows count for; bytes most, as their law must hold.
WEIGHTS = np.array([4.0, 1.0, 1.0])
SHARES = 8
SLICES = 64
CELL_GROUPS = 100_000
SLICE_ROWS = 100_000


def _pack(groups: DataFrame, shards: int) -> DataFrame:
    """``groups`` (cell, weight, bytes, tokens, rows, ...) with ``shard``.

    Rows come sorted by cell, then from the largest down.
    """
    schema = more(groups.schema, "shard int")
    names = groups.columns

    def place(batches):
        cell, left = None, None
        for batch in batches:
            cells = batch.column("cell").to_pylist()
            fair = np.stack(
                [batch.column(c).to_numpy(zero_copy_only=False) for c in ("cb", "ct", "cr")], 1
            )
            size = np.stack(
                [batch.column(c).to_numpy(zero_copy_only=False) for c in ("bytes", "tokens", "rows")],
                1,
            ).astype(float)
            size /= np.maximum(fair, 1)
            out = np.empty(len(cells), dtype=np.int32)
            for i, here in enumerate(cells):
                if here != cell:
                    cell, left = here, np.full((shards, 3), 1 / shards)
                at = int(np.argmax(left @ (size[i] * WEIGHTS)))
                left[at] -= size[i]
                out[i] = at
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(out)], names=[*names, "shard"]
            )

    return groups.mapInArrow(place, schema)


def assign_shards(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, size, text_crc32, tokens, shard, slot): a row for every row of ``docs``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        # Words, counted as the separators before them.
        F.regexp_count(F.concat(F.lit(" "), text), F.lit(r"[ \t-\r]+[^ \t-\r]"))
        .cast("long").alias("tokens"),
        F.xxhash64(text).alias("g1"),
        F.xxhash64(F.lit(1), F.col(text_col)).alias("g2"),
    ).withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(SLICES)).cast("int"))
    rows = settle(rows, "rows")
    key = ["g1", "g2"]
    pieces = rows.groupBy(*key, "slice").agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
        F.count(F.lit(1)).alias("rows"),
    )
    pieces = settle(pieces, "pieces")
    total = pieces.agg(F.sum("bytes"), F.sum("rows"), F.count(F.lit(1))).first()
    all_bytes, all_rows, all_pieces = (x or 0 for x in total)
    large = (
        pieces.groupBy(*key).agg(F.sum("bytes").alias("all"))
        .where(F.col("all") * SHARES * shards > all_bytes)
        .select(*key, F.lit(True).alias("large"))
    )
    large = settle(large, "large")

    def dealt(df: DataFrame) -> DataFrame:
        joined = df.join(F.broadcast(large), key, "left")  # under SHARES * shards rows
        return joined.withColumn("piece", F.when(F.col("large"), F.col("slice")).otherwise(-1))

    groups = dealt(pieces).groupBy(*key, "piece").agg(
        F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.sum("rows").alias("rows")
    )
    cells = -(-all_pieces // CELL_GROUPS) or 1
    groups = groups.withColumn("cell", F.pmod(F.xxhash64(*key, "piece"), F.lit(cells)))
    groups = settle(groups, "groups")
    fair = groups.groupBy("cell").agg(
        F.sum("bytes").alias("cb"), F.sum("tokens").alias("ct"), F.sum("rows").alias("cr")
    )
    groups = groups.join(fair, "cell").withColumn(
        "weight", F.expr("bytes / cb + tokens / greatest(ct, 1) + rows / cr")
    )
    packed = _pack(
        groups.repartition("cell").sortWithinPartitions(
            "cell", F.desc("weight"), F.desc("bytes"), *key, "piece"
        ),
        shards,
    ).select(*key, "piece", "shard")
    placed = dealt(rows).join(settle(packed, "packed"), [*key, "piece"])

    # Slots: places within (shard, part) behind the rows of the parts before.
    parts = -(-all_rows // (shards * SLICE_ROWS)) or 1
    placed = settle(
        placed.withColumn("part", F.pmod(F.xxhash64("id", "g1"), F.lit(parts))), "placed"
    )
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("shard", "part").orderBy("id", "g1")
    return (
        placed.withColumn("place", F.row_number().over(within) - 1)
        .join(counts, ["shard", "part"])
        .select(
            "id", "size", "text_crc32", "tokens", "shard",
            (F.col("offset") + F.col("place")).alias("slot"),
        )
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return assign_shards(docs).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "tokens",
    )
