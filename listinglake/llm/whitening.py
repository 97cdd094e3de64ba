"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Every entry becomes a whole number, so that sums over all vectors are exact.  With x the
whole vectors, S their sum, n their number and V their covariance, the leading eigenvectors
of V come from passes over the vectors alone; V itself, which has the square of the
dimensions, is never made.

1. Packing: the vectors are written once as blocks of whole numbers; S is added up in
   three limbs per dimension, which cannot run over.
2. A pass gives V Q for a block Q of orthonormal columns: each task centres its vectors (by
   the nearest whole number first, which loses nothing, then by the fraction), multiplies
   twice and sends one matrix; a few tasks add those up, and the driver gets one.
3. A cycle filters Q by a Chebyshev polynomial in V.  It is small on [0, cut], where cut is
   the least Ritz value of the block, and grows fast above; its three-term recurrence takes a
   pass a degree.  Then QR, and Rayleigh-Ritz with one more pass.
4. The cycles end when the residuals |V u - e u| of all wanted components are below TOLERANCE
   of the largest eigenvalue.  Every cycle also filters a few new random columns; an
   eigenvector that the block had missed would come up in them.
5. A last pass takes the covariance of the whitened vectors, the certificate returned as
   ``identity_error``.

Results for odd input: vectors that are null, or hold null or non-finite entries, or
entries whose whole number does not fit a long, are dropped; so are vectors whose length is
not the most common one (ties: the longest) and empty ones.  Rows without id are kept, rows
that repeat count each.  Components without variance (below RANK of the largest) are left
out, so equal vectors, a single one or none give no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.llm.common import settle, table

SCALE, SHIFT = 1024, 100_000  # an entry c becomes floor(SCALE * c) + SHIFT
COMPONENTS = 8
GUARD = 32  # columns beyond the wanted ones; they widen the gap that the filter works on
FRESH = 2  # of them, new ones each cycle
DEGREES = (6, 12)  # least and most of a cycle's filter
TOLERANCE = 5e-14
STALLED = 3  # cycles without progress, near the limits of double precision
GOOD = 1e-11  # residuals that are good enough when there is no progress any more
RANK = 1e-12
BLOCK_VALUES = 1 << 18
SUMMERS = 8  # tasks that add up what the others found
LIMBS = 21  # bits

# ---- packing --------------------------------------------------------------------


def _rows_of(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which rows are usable, their lengths, their entries one after another)."""
    lengths = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(vectors)), np.maximum(lengths, 0))
    # Null entries read as nan; whole numbers beyond a long would wrap.
    wrong = ~(np.abs(flat) < 2.0**52)
    usable = lengths > 0
    usable[owner[wrong]] = False
    return usable, lengths, flat[usable[owner]]


def _packed(vectors: DataFrame) -> DataFrame:
    """Blocks (ids, x, size, dim, rows): the whole numbers of vectors of one length."""

    def pack(batches):
        for batch in batches:
            vector = batch.column(1)
            if isinstance(vector, pa.ChunkedArray):
                vector = vector.combine_chunks()
            usable, lengths, flat = _rows_of(vector)
            ids = batch.column(0).filter(pa.array(usable))
            lengths = lengths[usable]
            whole = np.floor(SCALE * flat).astype(np.int64) + SHIFT
            begin = np.cumsum(lengths) - lengths
            for dim in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dim)
                step = max(1, BLOCK_VALUES // dim)
                for i in range(0, len(at), step):
                    some = at[i : i + step]
                    x = whole[begin[some][:, None] + np.arange(dim)]
                    small = bool((np.abs(x) < 2**31).all())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([ids.take(pa.array(some)).to_pylist()], pa.list_(pa.int64())),
                            pa.array([x.astype("<i4" if small else "<i8").tobytes()], pa.binary()),
                            pa.array([4 if small else 8], pa.int32()),
                            pa.array([dim], pa.int32()),
                            pa.array([len(some)], pa.int64()),
                        ],
                        names=["ids", "x", "size", "dim", "rows"],
                    )

    schema = "ids array<long>, x binary, size int, dim int, rows long"
    return vectors.mapInArrow(pack, schema)


def _whole(batch: pa.RecordBatch):
    """The whole-number matrices of a batch of blocks."""
    columns = [batch.column(batch.schema.get_field_index(c)) for c in ("x", "size", "dim")]
    for x, size, dim in zip(columns[0], columns[1].to_pylist(), columns[2].to_pylist()):
        values = np.frombuffer(x.as_buffer(), dtype=f"<i{size}").astype(np.int64)
        yield values.reshape(-1, dim)


def _summed(blocks: DataFrame, find: Callable, kind: str) -> np.ndarray:
    """The sum over all blocks of ``find(whole numbers)``, an array of always the same length."""

    def each(batches):
        total = None
        for batch in batches:
            for x in _whole(batch):
                found = find(x)
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    def add(batches):
        total = None
        for batch in batches:
            for part in batch.column(0):
                found = np.frombuffer(part.as_buffer(), dtype=kind)
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    parts = blocks.select("x", "size", "dim").mapInArrow(each, "part binary")
    parts = parts.repartition(SUMMERS).mapInArrow(add, "part binary").collect()
    return np.sum([np.frombuffer(r["part"], dtype=kind) for r in parts], axis=0)


class Centre(NamedTuple):
    """What all vectors have in common; a few numbers per dimension."""

    n: int
    total: list[int]  # S
    near: np.ndarray  # the whole numbers next to the means
    rest: np.ndarray  # the means without them

    def of(self, x: np.ndarray) -> np.ndarray:
        return (x - self.near).astype(np.float64) - self.rest


def _centre(blocks: DataFrame, n: int, dim: int) -> Centre:
    mask = (1 << LIMBS) - 1

    def limbs(x):
        parts = (x >> 2 * LIMBS, (x >> LIMBS) & mask, x & mask)
        return np.concatenate([p.sum(axis=0) for p in parts])

    high, middle, low = _summed(blocks, limbs, "<i8").reshape(3, dim).tolist()
    total = [(h << 2 * LIMBS) + (m << LIMBS) + k for h, m, k in zip(high, middle, low)]
    near = [round(Fraction(s, n)) for s in total]
    rest = [float(Fraction(s, n) - m) for s, m in zip(total, near)]
    return Centre(n, total, np.array(near, dtype=np.int64), np.array(rest))


# ---- eigenvectors ---------------------------------------------------------------


class Spectrum(NamedTuple):
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # a column each
    trace: float
    residual: float  # the largest, as a share of the first eigenvalue
    passes: int


def leading(
    times: Callable[[np.ndarray], np.ndarray], dim: int, trace: float, wanted: int, seed: int = 1
) -> Spectrum:
    """The ``wanted`` leading eigenpairs of the symmetric V that ``times`` multiplies with."""
    rng = np.random.default_rng(seed)
    width = min(dim, wanted + GUARD)
    wanted = min(wanted, width)
    q = np.linalg.qr(rng.standard_normal((dim, width)))[0]
    vq = times(q)
    passes, best, stalled = 1, np.inf, 0
    while True:
        h = q.T @ vq
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = max(values[0], 0.0)
        if top <= 0:
            return Spectrum(values[:0], q[:, :0], trace, 0.0, passes)
        off = np.linalg.norm(vq - q * values, axis=0)[:wanted].max() / top
        stalled = 0 if off < best / 2 else stalled + 1
        best = min(best, off)
        # The first block is random all over; later ones hold columns to find what it missed.
        confirmed = passes > 1 or width == dim
        if confirmed and (off <= TOLERANCE or (off <= GOOD and stalled >= STALLED)):
            keep = values[:wanted] > RANK * top
            return Spectrum(values[:wanted][keep], q[:, :wanted][:, keep], trace, off, passes)
        if width == dim:  # the whole space: rounding is all that is left to remove
            q = np.linalg.qr(q)[0]
        else:
            fresh = min(FRESH, width - wanted)
            cut = max(values[width - fresh - 1], 1e-8 * top)
            q[:, width - fresh :] = rng.standard_normal((dim, fresh)) / np.sqrt(dim)
            q, degree = _filtered(times, q, cut, top, values[wanted - 1], off)
            passes += degree
        vq = times(q)
        passes += 1


def _filtered(times, q, cut, top, least, off) -> tuple[np.ndarray, int]:
    """``q`` under a polynomial that is small on [0, cut]; orthonormal again; its degree."""
    half = cut / 2
    growth = np.arccosh(max((least - half) / half, 1 + 1e-6))
    need = np.log(max(off / TOLERANCE, 10.0)) / growth
    degree = int(np.clip(np.ceil(need), *DEGREES))
    first = half / (top - half)  # scaled so that the largest eigenvalue's factor stays 1
    scale, before = first, q
    now = (times(q) - half * q) * (first / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        now, before = (
            (times(now) - half * now) * (2 * following / half) - before * (scale * following),
            now,
        )
        scale = following
    # Columns first made equally long, so that QR does not lose the short ones.
    now /= np.maximum(np.linalg.norm(now, axis=0), np.finfo(float).tiny)
    return np.linalg.qr(now)[0], degree


# ---- the operator ---------------------------------------------------------------


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """A row per usable vector and component, with the columns of the module's contract.

    (id, component, n, deviation decimal(38,0), whitened, explained, identity_error)
    """
    spark = vectors.sparkSession
    schema = (
        "id long, component int, n long, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double"
    )
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")
    )
    blocks = settle(_packed(rows), "vectors")
    dims = blocks.groupBy("dim").agg(F.sum("rows").alias("n"))
    usual = dims.orderBy(F.desc("n"), F.desc("dim")).head(1)
    if not usual:
        return spark.createDataFrame([], schema)
    dim, n = usual[0]["dim"], usual[0]["n"]
    blocks = blocks.where(F.col("dim") == dim)
    centre = _centre(blocks, n, dim)

    def times(q: np.ndarray) -> np.ndarray:
        def one(x):
            c = centre.of(x)
            return (c.T @ (c @ q)).reshape(-1)

        return _summed(blocks, one, "<f8").reshape(q.shape) / n

    squares = _summed(blocks, lambda x: (centre.of(x) ** 2).sum(axis=0), "<f8")
    found = leading(times, dim, float(squares.sum()) / n, components)
    if not len(found.values):
        return spark.createDataFrame([], schema)
    # The sign is free; the entry of largest size is made positive.
    largest = np.abs(found.vectors).argmax(axis=0)
    sign = np.sign(found.vectors[largest, np.arange(len(found.values))])
    project = found.vectors * sign / np.sqrt(found.values)
    k = len(found.values)

    def moments(x):
        z = centre.of(x) @ project
        return np.concatenate([z.sum(axis=0), (z.T @ z).reshape(-1)])

    sums = _summed(blocks, moments, "<f8") / n
    covariance = sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k])
    error = float(np.abs(covariance - np.eye(k)).max())
    explained = found.values / found.trace
    left = [s - n * int(m) for s, m in zip(centre.total, centre.near)]

    def out(batches):
        for batch in batches:
            for ids, x in zip(batch.column(0), _whole(batch)):
                m = len(x)
                deviation = _deviations(x - centre.near, n, left)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids.as_py(), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n, dtype=np.int64)),
                        deviation.take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array((centre.of(x) @ project).reshape(-1)),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    names=[f.split()[0] for f in schema.replace("38,0", "38").split(", ")],
                )

    return blocks.select("ids", "x", "size", "dim").mapInArrow(out, schema)


def _deviations(x: np.ndarray, n: int, left: list[int]) -> pa.Array:
    """Sums over the dimensions of (n x - left) ** 2, exact."""
    kind = pa.decimal128(38, 0)
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, left))
    if most**2 * x.shape[1] < 2**63:
        off = n * x - np.array(left, dtype=np.int64)
        return pa.array((off * off).sum(axis=1)).cast(kind)
    sums = (sum((n * v - s) ** 2 for v, s in zip(row, left)) for row in x.tolist())
    return pa.array([Decimal(s) if s < 10**38 else None for s in sums], kind)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deviation as a long; null where only ``deviation_exact`` can hold it."""
    rows = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return rows.select(
        F.col("id").alias("vec_id"), "component", "n",
        F.expr("try_cast(deviation as long)").alias("deviation"), "whitened", "explained",
        "identity_error", F.col("deviation").alias("deviation_exact"),
    )
