"""What the operators share: tables, results that cut lineage, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from listinglake.session import checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]

# A-Z to a-z and nothing else, as the contracts ask for.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Size of the bit tables that let a scan skip rows nobody asked for: 2 MB, whatever the input.
MARK_BITS = 24
MARK_SLICES = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def more(schema: StructType, ddl: str) -> StructType:
    """``schema`` and further columns."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front until ``df`` has no such columns."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def settle(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder of ``spark.checkpoint.dir`` and read it back.

    The result has no lineage: a lost executor costs the tasks it ran, not the steps
    before.  The files stay until the folder is cleared.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/listinglake/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def giving_back(run: Callable) -> Callable:
    """``run`` over Arrow batches; behind a task, what Arrow holds unused goes to the system.

    Workers live on in later stages, which may need the memory themselves.
    """

    def task(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return task


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every end of ``links(a, b)``; component is the smallest node.

    Alternating large-star and small-star rounds: every round is two groupings, whose
    minima combine before the shuffle, and joins that run-time skew handling may split.
    A hub of any degree therefore never meets in one task.  Ends when the star forest
    no longer changes.
    """
    edges = (
        links.where("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    edges = settle(edges, name)
    while True:
        # Large star: every neighbour above a node moves to the smallest node around it.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), "m")
        large = large.where("a != m").distinct()
        # Small star: a node and its neighbours below move to the smallest of them.
        low = large.groupBy("a").agg(F.min("m").alias("m"))
        small = (
            large.withColumnRenamed("m", "b")
            .join(low, "a")
            .where("b != m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        after = small.union(low.select("a", F.col("m").alias("b"))).distinct()
        after = settle(after, name)
        # Done when each node hangs on one root and no root hangs on another.
        ends = after.selectExpr("a", "1 as up", "0 as down").union(
            after.selectExpr("b as a", "0 as up", "1 as down")
        )
        ends = ends.groupBy("a").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        edges = after
        if not ends.where("up > 1 or (up > 0 and down > 0)").take(1):
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select("b", "b").distinct())


class Recent:
    """What a worker remembers of the values it has computed, in two generations.

    A full generation becomes the old one, and an older one is forgotten, so memory is
    bounded and values in frequent use stay.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict = {}
        self.old: dict = {}

    def hold(self, keys: set, make: Callable[[list], dict]) -> dict:
        """The values of all ``keys``; ``make`` computes those that are not known."""
        distinct = list(keys)
        return dict(zip(distinct, self.values(distinct, make)))

    def values(self, keys: list, make: Callable[[list], dict]) -> list:
        """The values of distinct ``keys``, in their order."""
        young, old = self.young, self.old
        rest = [k for k in keys if k not in young]
        again = {k: old[k] for k in rest if k in old}
        again |= make([k for k in rest if k not in again])
        if len(young) + len(again) > self.limit:
            self.old, self.young = young, again
            return [again[k] if k in again else young[k] for k in keys]
        young |= again
        return [young[k] for k in keys]

    def forget(self, keys: Iterable) -> None:
        """``keys`` that were computed by the last call count as not known."""
        for k in keys:
            self.young.pop(k, None)


# ---- fixed-size bit tables ------------------------------------------------------


def mark_of(values: np.ndarray) -> np.ndarray:
    """The bit a 64-bit hash falls on."""
    mixed = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - MARK_BITS)).astype(np.int64)


def mark_table(df: DataFrame, column: str) -> np.ndarray:
    """A table of 2**24 bits in which the bits of all values of ``column`` (long) are set.

    Its size does not depend on the input.  A scan that asks it whether a row may matter
    gets every row that does and some that don't; what follows decides exactly.
    Every task sets bits in its own table; the tables are merged slice by slice, by
    streaming, and only the merged 2 MB reach the driver.
    """
    width = (1 << MARK_BITS) // 8 // MARK_SLICES

    def mark(batches):
        bits = np.zeros(1 << MARK_BITS, dtype=bool)
        for batch in batches:
            bits[mark_of(batch.column(0).to_numpy(zero_copy_only=False))] = True
        packed = np.packbits(bits).reshape(MARK_SLICES, width)
        full = [i for i in range(MARK_SLICES) if packed[i].any()]
        yield pa.RecordBatch.from_pydict(
            {
                "slice": pa.array(full, pa.int32()),
                "bits": pa.array([packed[i].tobytes() for i in full], pa.binary()),
            }
        )

    def merge(batches):
        merged: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(bits, dtype=np.uint8)
                merged[i] = merged[i] | part if i in merged else part
        yield pa.RecordBatch.from_pydict(
            {
                "slice": pa.array(list(merged), pa.int32()),
                "bits": pa.array([x.tobytes() for x in merged.values()], pa.binary()),
            }
        )

    schema = "slice int, bits binary"
    parts = df.select(column).where(F.col(column).isNotNull()).mapInArrow(mark, schema)
    out = np.zeros((MARK_SLICES, width), dtype=np.uint8)
    for row in parts.repartition("slice").mapInArrow(merge, schema).collect():
        out[row["slice"]] |= np.frombuffer(row["bits"], dtype=np.uint8)
    return out.reshape(-1)


def marked(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = mark_of(values)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
