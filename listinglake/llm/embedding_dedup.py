"""Near-duplicate vectors: iterative quantisation, multi-index Hamming tables, rerank.

1. Codes.  On a bounded sample (SAMPLE vectors, by hash of the id) the principal axes and a
   rotation are learnt that makes the signs of the rotated components balanced, faithful
   bits (ITQ).  Every vector of the input then gets its code of up to 64 bits.
2. Tables.  A code is cut into TABLES parts.  Two codes that differ in fewer than
   TABLES * (RADIUS + 1) bits agree in some part up to RADIUS bits.  One side lists its
   parts, the other its parts with up to RADIUS bits flipped, and they meet in an equi-join;
   a Hamming bound on the whole code drops most of what only one part brought together.
   How many rotations, each with tables of its own, and which bound: that is tried out on
   pairs of the sample, true ones and made ones at just the threshold.  Where vectors share
   a direction, their centred codes differ more, and more rotations are used.
3. Rerank.  Pairs found are compared by cosine of the original vectors in double
   precision.  None below the threshold is linked.

Equal vectors are one class from the start and are not compared with each other: a class
carries its number of members, so copies in any number cost one row each.  Classes are
numbered, whatever ids their members have.

The index is approximate: a pair whose code parts all differ by more than RADIUS bits is not
found.  Recall is measured against brute force in the tests and given in the README.

Results for odd input: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing (n_links 0, component = own id, kept); vectors of different
lengths do not link; rows that repeat an id and vector are one vector and get equal rows;
rows that repeat an id with another vector are vectors of their own;
rows without id get a null component; with fewer than two usable vectors nothing is linked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.llm.common import components, settle, table

THRESHOLD = 0.95
BITS = 64
TABLES = 4
RADIUS = 1
# Codes further apart are not reranked: over twice the bits expected at cosine 0.95, or what
# nearly all of the tried pairs need, if that is more.
MOST_BITS = 20
MOST_SHARE = 0.999
SAMPLE = 4096
# Shares of the tried pairs that the tables have to find: true ones, and those made at the
# threshold, which are the hardest there are.
TRUE_FOUND, MADE_FOUND = 0.97, 0.93
MOST_ROTATIONS = 8
ROUNDS = 30


class Quantiser:
    """Mean, projection and rotation learnt from unit vectors."""

    def __init__(self, sample: np.ndarray, bits: int = BITS, rounds: int = ROUNDS, seed: int = 0):
        self.mean = sample.mean(0)
        centred = sample - self.mean
        _, axes = np.linalg.eigh(centred.T @ centred)
        self.bits = min(bits, sample.shape[1])
        axes = axes[:, ::-1][:, : self.bits]
        projected = centred @ axes
        random = np.random.default_rng(seed).standard_normal((self.bits, self.bits))
        rotation, _ = np.linalg.qr(random)
        for _ in range(rounds):
            signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(signs.T @ projected)
            rotation = (left @ right).T
        self.map = axes @ rotation

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """Codes as 64-bit integers; vectors of another length are cut or filled with 0."""
        size = len(self.mean)
        if unit.shape[1] != size:
            fitted = np.zeros((len(unit), size))
            width = min(size, unit.shape[1])
            fitted[:, :width] = unit[:, :width]
            unit = fitted
        on = (unit - self.mean) @ self.map >= 0
        places = np.uint64(1) << np.arange(self.bits, dtype=np.uint64)
        return (on * places).sum(1, dtype=np.uint64)


    def found(self, x: np.ndarray, y: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """For pairs of unit vectors: whether a table brings them together, bits that differ."""
        width = -(-self.bits // TABLES)
        differ = self.codes(x) ^ self.codes(y)
        mask = np.uint64((1 << width) - 1)
        met = np.zeros(len(x), dtype=bool)
        for t in range(TABLES):
            met |= _bits(differ >> np.uint64(t * width) & mask) <= radius
        return met, _bits(differ)


def _bits(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values).astype(np.int64)


def _tried_pairs(unit: np.ndarray, threshold: float, seed: int = 3):
    """(x, y) of true pairs in the sample, and of made ones whose cosine is the threshold.

    The second vector leans from the first one towards another vector of the sample, so
    the difference is one that the data have.
    """
    true = [(np.zeros(0, int), np.zeros(0, int))]
    for i in range(0, len(unit), 512):
        a, b = np.nonzero(unit[i : i + 512] @ unit.T >= threshold)
        a = a + i
        true.append((a[a < b], b[a < b]))
    a, b = (np.concatenate(x) for x in zip(*true))
    rng = np.random.default_rng(seed)
    some = rng.permutation(len(a))[: 4 * SAMPLE]
    other = unit[rng.permutation(len(unit))]
    aside = other - (other * unit).sum(1, keepdims=True) * unit
    length = np.sqrt((aside**2).sum(1))
    usable = length > 1e-6
    aside = aside[usable] / length[usable, None]
    made = threshold * unit[usable] + np.sqrt(1 - threshold**2) * aside
    return (unit[a[some]], unit[b[some]]), (unit[usable], made)


def choose_tools(unit: np.ndarray, threshold: float, radius: int) -> tuple[list[Quantiser], int]:
    """Rotations that find enough of the tried pairs, and the most bits that may differ."""
    tried = _tried_pairs(unit, threshold)
    tools: list[Quantiser] = []
    met = [np.zeros(len(x), dtype=bool) for x, _ in tried]
    most = MOST_BITS
    while len(tools) < MOST_ROTATIONS:
        tool = Quantiser(unit, seed=len(tools))
        tools.append(tool)
        for i, (x, y) in enumerate(tried):
            found, differ = tool.found(x, y, radius)
            met[i] |= found
            if found.any():
                most = max(most, int(np.quantile(differ[found], MOST_SHARE)))
        shares = [m.mean() if len(m) else 1.0 for m in met]
        if shares[0] >= TRUE_FOUND and shares[1] >= MADE_FOUND:
            break
    return tools, most


def _unit(vectors) -> np.ndarray:
    """Vectors of length 1; the largest entry becomes 1 first, so that no square overflows."""
    out = np.array(vectors, dtype=float)
    out = out / np.abs(out).max(1, keepdims=True)
    return out / np.sqrt((out**2).sum(1, keepdims=True))


def _matrices(column: pa.Array):
    """(rows, matrix of their vectors) for each length in a list column."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    begin = np.cumsum(lengths) - lengths
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        yield at, flat[begin[at][:, None] + np.arange(n)]


def _classes(vectors: DataFrame) -> DataFrame:
    """(class, k1, k2, id, size, vector) of the usable vectors; id is the least one.

    The number is given when the classes are written, so it stays.
    """
    return (
        vectors.where("usable and id is not null")
        .groupBy("k1", "k2")
        .agg(F.min(F.struct("id", "vector")).alias("first"), F.count_distinct("id").alias("size"))
        .select("k1", "k2", "first.id", "size", "first.vector")
        .withColumn("class", F.monotonically_increasing_id())
    )


def link_vectors(
    frame: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    radius: int = RADIUS,
) -> DataFrame:
    """(id, n_links, component_id, kept): a row for every row of ``frame``."""
    spark = frame.sparkSession
    vector = F.col(vector_col)
    vectors = frame.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector")).select(
        "id",
        "vector",
        F.xxhash64("vector").alias("k1"),
        F.xxhash64(F.lit(1), "vector").alias("k2"),
        F.coalesce(
            (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull())
            & F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("vector", lambda x: x != 0),
            F.lit(False),
        ).alias("usable"),
    )
    classes = settle(_classes(vectors), "classes")
    # Learn on the most frequent length; SAMPLE rows reach the driver.
    length = classes.groupBy(F.size("vector").alias("n")).count()
    length = length.orderBy(F.desc("count"), "n").first()
    if length is None:
        pairs = spark.createDataFrame([], "a long, b long")
    else:
        sample = (
            classes.where(F.size("vector") == length["n"])
            .orderBy("k1", "k2")
            .limit(SAMPLE)
            .select("vector")
            .collect()
        )
        unit = _unit([r["vector"] for r in sample])
        tools, most_bits = choose_tools(unit, threshold, radius)
        pairs = _near(classes, tools, most_bits, threshold, radius)
    pairs = settle(pairs, "pairs")

    sizes = classes.select("class", "size")
    both = pairs.union(pairs.select("b", "a"))
    others = (
        both.join(sizes.select(F.col("class").alias("b"), "size"), "b")
        .groupBy(F.col("a").alias("class"))
        .agg(F.sum("size").alias("others"))
    )
    home = components(pairs).select(F.col("node").alias("class"), "component")
    # The smallest id of a component, over the classes in it.
    least = (
        home.join(classes.select("class", "id"), "class")
        .groupBy("component")
        .agg(F.min("id").alias("component_id"))
    )
    home = home.join(least, "component").select("class", "component_id")
    point = (
        classes.select("class", "k1", "k2", "id", "size")
        .join(others, "class", "left")
        .join(home, "class", "left")
        .select(
            "k1", "k2", F.lit(True).alias("usable"),
            (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
    )
    return (
        vectors.join(point, ["k1", "k2", "usable"], "left")
        .select(
            "id",
            F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0)))
            .cast("long").alias("n_links"),
            F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
    )


def _near(
    classes: DataFrame, tools: list[Quantiser], most_bits: int, threshold: float, radius: int
) -> DataFrame:
    """Pairs (a < b) of classes with cosine of at least ``threshold``."""
    bits = tools[0].bits
    width = -(-bits // TABLES)

    def encode(batches):
        for batch in batches:
            codes = np.zeros((batch.num_rows, len(tools)), dtype=np.uint64)
            for at, matrix in _matrices(batch.column("vector")):
                unit = _unit(matrix)
                for t, tool in enumerate(tools):
                    codes[at, t] = tool.codes(unit)
            bounds = pa.array(np.arange(batch.num_rows + 1) * len(tools), pa.int32())
            flat = pa.array(codes.view(np.int64).reshape(-1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), pa.ListArray.from_arrays(bounds, flat)],
                names=["class", "codes"],
            )

    codes = classes.select("class", "vector").mapInArrow(encode, "class long, codes array<long>")
    codes = settle(codes, "codes")
    codes = codes.select("class", F.posexplode("codes").alias("turn", "code"))
    cut = F.array(
        *[
            F.shiftrightunsigned("code", t * width).bitwiseAND(F.lit((1 << width) - 1))
            for t in range(TABLES)
        ]
    )
    parts = codes.select("class", "turn", "code", F.posexplode(cut).alias("table", "part"))
    flips = [0]
    for _ in range(radius):
        flips = sorted({f ^ (1 << i) for f in flips for i in range(width)} | set(flips))
    probes = parts.select(
        F.col("class").alias("a"), F.col("code").alias("code_a"), "turn", "table",
        F.explode(F.transform(F.array(*map(F.lit, flips)), lambda f: f.bitwiseXOR(F.col("part"))))
        .alias("part"),
    )
    tables = parts.select(
        F.col("class").alias("b"), F.col("code").alias("code_b"), "turn", "table", "part"
    )
    found = (
        probes.join(tables, ["turn", "table", "part"])
        .where("a < b")
        .where(F.bit_count(F.col("code_a").bitwiseXOR(F.col("code_b"))) <= most_bits)
        .select("a", "b")
        .distinct()
    )
    vectors = classes.select("class", "vector")
    pairs = found.join(
        vectors.select(F.col("class").alias("a"), F.col("vector").alias("x")), "a"
    ).join(vectors.select(F.col("class").alias("b"), F.col("vector").alias("y")), "b")

    def rerank(batches):
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            same = x.value_lengths().to_numpy(zero_copy_only=False) == y.value_lengths().to_numpy(
                zero_copy_only=False
            )
            batch = batch.filter(pa.array(same))
            cosine = np.zeros(batch.num_rows)
            left, right = _matrices(batch.column("x")), _matrices(batch.column("y"))
            for (at, one), (_, other) in zip(left, right):
                cosine[at] = (_unit(one) * _unit(other)).sum(1)
            yield batch.select(["a", "b"]).filter(pa.array(cosine >= threshold))

    return pairs.select("a", "b", "x", "y").mapInArrow(rerank, "a long, b long")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return link_vectors(vectors).withColumnRenamed("id", "vec_id")
