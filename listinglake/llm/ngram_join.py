"""Which texts share at least 75 % of their five-word shingles: a metric-space join.

Sets of shingles with the distance 1 - Jaccard are a metric space; linked means closer
than EPS = 0.25.  Most pairs of texts have no shingle in common, that is, distance 1 to
nearly everything, where distances to whole documents as pivots tell nothing.  So the
space is cut in two steps.

1. Outer regions.  The pivots are the one-shingle sets.  A text is at 1 - 1/n from those it
   contains and at 1 from all others; among its equally near pivots the rarest one (then
   the smallest hash) owns the text.  That is its Voronoi region.  A linked text lies in
   another region only if it lacks all pivots that come before; lacking r of n puts it at
   r/n or farther, so a text is copied into the regions of its first floor(n/4) + 1 pivots
   and no others (the window).  Two linked texts meet in the region of their first common
   pivot.
2. Inner regions, by recursion.  In a region the pivots are documents.  Every text is
   measured against the pivot it shares most regions with.  Those nearer than EPS are
   linked to it and need no more comparing with each other, as only connected groups are
   asked for.  The texts outside the ball form the next level's region, with a new pivot.
3. Boundary.  Texts of a region that are still apart are compared directly, unless their
   sizes, their places in the order, or what both share with a common pivot (the triangle
   inequality, made narrower) rule out a link.

Equal sets are one point of the space from the start.  Rarity comes from a counting table
of fixed size over all texts; it decides only the order, never a result, so its
collisions cost at most time.  Shingles are compared by 64-bit hashes; sets are told apart by
128 bits and joined by 64 of them.

Results for odd input: null or empty texts, and texts without words, have no shingles and
are linked with nothing (component = own id); texts below five words are one shingle; rows
without id are returned with a null component; rows that repeat an id with another text are
documents of their own, which ``text_hash`` tells apart; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.llm.common import (
    components, giving_back, mark_table, marked, more, settle, table,
)
from listinglake.llm.wordhash import mix, pieces, shingle_sets

SHINGLE = 5
# Linked when 100 * intersection >= PERCENT * union.
PERCENT = 75
LEVELS = 2

COUNT_BITS = 22  # the counting table: 2**22 counters of 4 bytes, 16 MB
COUNT_SLICES = 64
# Regions expected to hold more rows than this are dealt to several tasks.
REGION_ROWS = 1 << 16
RANK_BITS = 26  # 67 million shingles a text
# Bytes of text looked at together; the arrays take some fifty times that.
PIECE = 1 << 18
# Regions of so many points keep them all: pairs of a group are found by its centre there.
CENTRED = 12
# Rows of a region that are looked at together; larger ones go on as they are.
HELD_ROWS = 1 << 18


def _counter_of(values: np.ndarray) -> np.ndarray:
    return (mix(values ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(64 - COUNT_BITS)).astype(
        np.int64
    )


def _key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return (
        int.from_bytes(digest[:8], "little", signed=True),
        int.from_bytes(digest[8:], "little", signed=True),
    )


def _profile(docs: DataFrame, k: int) -> DataFrame:
    """A row per document (id, text_hash, n, key, key2), and rows with each task's counts."""
    width = (1 << COUNT_BITS) // COUNT_SLICES

    def profile(batches):
        counts = np.zeros(1 << COUNT_BITS, dtype=np.uint32)
        for batch in batches:
            for part in pieces(batch, "text", PIECE):
                sets = shingle_sets(part.column("text"), k)
                if sets:
                    at, times = np.unique(_counter_of(np.concatenate(sets)), return_counts=True)
                    counts[at] += times.astype(np.uint32)
                keys = [_key(s) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("text_hash"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([x for x, _ in keys], pa.int64()),
                        pa.array([x for _, x in keys], pa.int64()),
                        pa.nulls(len(sets), pa.int32()),
                        pa.nulls(len(sets), pa.binary()),
                    ],
                    names=["id", "text_hash", "n", "key", "key2", "slice", "counts"],
                )
        parts = counts.reshape(COUNT_SLICES, width)
        full = [i for i in range(COUNT_SLICES) if parts[i].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(full), pa.int64())] * 5
            + [
                pa.array(full, pa.int32()),
                pa.array([_packed(parts[i]) for i in full], pa.binary()),
            ],
            names=["id", "text_hash", "n", "key", "key2", "slice", "counts"],
        )

    return docs.mapInArrow(
        giving_back(profile), "id long, text_hash long, n long, key long, key2 long, slice int, counts binary"
    )


def _packed(counts: np.ndarray) -> bytes:
    """Counters byte by byte: the upper bytes of small ones are zeros side by side."""
    return zlib.compress(counts.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    parts = np.frombuffer(zlib.decompress(packed), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(parts.T).view(np.uint32).reshape(-1)


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of two counts; one that would run over stays at the greatest value."""
    total = a + b
    return np.where(total < a, np.uint32(0xFFFFFFFF), total)


def _shingle_counts(profile: DataFrame) -> np.ndarray:
    """The counting tables of all tasks, added up slice by slice; 16 MB reach the driver."""

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = _unpacked(counts)
                total[i] = _add(total[i], part) if i in total else part
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(total), pa.int32()),
                pa.array([x.tobytes() for x in total.values()], pa.binary()),
            ],
            names=["slice", "counts"],
        )

    parts = profile.where("slice is not null").select("slice", "counts")
    out = np.zeros((COUNT_SLICES, (1 << COUNT_BITS) // COUNT_SLICES), dtype=np.uint32)
    for row in parts.repartition("slice").mapInArrow(add, "slice int, counts binary").collect():
        out[row["slice"]] = np.frombuffer(row["counts"], dtype=np.uint32)
    return out.reshape(-1)


def _regions(
    docs: DataFrame, points: DataFrame, counts: np.ndarray, k: int, percent: int
) -> DataFrame:
    """(pivot, key, n, rank): the regions each point lies in or is copied to.

    A row stays only if some other point of its region could be linked to it with the
    pivot as first common shingle, by the sizes and the point's own place there.  Every
    link has its two rows in the region of its first common pivot, so none is lost.
    """
    order = docs.sparkSession.sparkContext.broadcast(counts)
    # A point is placed by the document that stands for it; most copies are passed over.
    named = docs.sparkSession.sparkContext.broadcast(mark_table(points, "id"))
    ones = (1 << RANK_BITS) - 1

    def place(batches):
        seen: set[int] = set()
        counts = order.value
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            batch = batch.filter(pa.array(marked(named.value, ids)))
            for part in pieces(batch, "text", PIECE):
                out = [[], [], []]
                for shingles in shingle_sets(part.column("text"), k):
                    n = len(shingles)
                    if not n:
                        continue
                    key = _key(shingles)[0]
                    if key in seen:
                        continue
                    if len(seen) >= 50_000:  # only saves work: equal rows go below
                        seen.clear()
                    seen.add(key)
                    rarity = counts[_counter_of(shingles)].astype(np.int64)
                    reach = n * (100 - percent) // 100 + 1
                    first = np.lexsort((shingles, rarity))[:reach]
                    slices = rarity[first] // REGION_ROWS + 1
                    at = ((key % slices) % (1 << 11)) << (2 * RANK_BITS)
                    out[0].append(shingles[first].view(np.int64))
                    out[1].append(at + (n << RANK_BITS) + np.arange(len(first)))
                    out[2].append(np.full(len(first), key, dtype=np.int64))
                if out[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in out],
                        names=["pivot", "at", "key"],
                    )

    def shared(batches):
        """Rows that may meet a partner in their region; rows come sorted by pivot and key."""
        names = ["pivot", "at", "key"]
        held = [np.zeros(0, dtype=np.int64)] * 3  # the last region, which may go on
        open_pivot = None  # a region too large to be held; its rows all go through

        def send(cols, every=False):
            pivot, at, key = cols
            fresh = np.ones(len(pivot), dtype=bool)
            fresh[1:] = (pivot[1:] != pivot[:-1]) | (key[1:] != key[:-1])
            pivot, at, key = (c[fresh] for c in cols)
            if not every:
                group = np.cumsum(np.concatenate([[0], pivot[1:] != pivot[:-1]])) if len(pivot) else pivot
                n, rank = (at >> RANK_BITS) & ones, at & ones
                # A region dealt to several tasks may have its other points elsewhere, and
                # one of many points is where the levels below find its centre.
                whole = counts_hot(pivot) | (np.bincount(group)[group] >= CENTRED)
                keep = may_meet(group, n, rank, percent) | whole
                # Partners that went away leave others without one.
                keep[keep] = may_meet(group[keep], n[keep], rank[keep], percent) | whole[keep]
                pivot, at, key = pivot[keep], at[keep], key[keep]
            for i in range(0, len(pivot), 1 << 16):
                part = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[part]) for c in (pivot, at, key)], names=names
                )

        for batch in batches:
            cols = [
                np.concatenate([h, batch.column(c).to_numpy(zero_copy_only=False)])
                for h, c in zip(held, names)
            ]
            pivot = cols[0]
            if not len(pivot):
                continue
            if open_pivot is not None:
                till = int(np.searchsorted(pivot != open_pivot, True))
                yield from send([c[:till] for c in cols], every=True)
                cols = [c[till:] for c in cols]
                pivot = cols[0]
                if not len(pivot):
                    held = cols
                    continue
                open_pivot = None
            last = len(pivot) - int(np.searchsorted((pivot != pivot[-1])[::-1], True))
            yield from send([c[:last] for c in cols])
            held = [c[last:] for c in cols]
            if len(held[0]) > HELD_ROWS:
                open_pivot = held[0][0]
                yield from send([c[:-1] for c in held], every=True)
                held = [c[-1:] for c in held]
        yield from send(held, every=open_pivot is not None)

    def counts_hot(pivot: np.ndarray) -> np.ndarray:
        return order.value[_counter_of(pivot.view(np.uint64))] >= REGION_ROWS

    # Slice, size and rank travel in one number: these rows are the most of the shuffle.
    schema = "pivot long, at long, key long"
    return (
        docs.where("id is not null")
        .select("id", "text")
        .mapInArrow(giving_back(place), schema)
        .repartition("pivot", F.shiftright("at", 2 * RANK_BITS))
        .sortWithinPartitions("pivot", "key")
        .mapInArrow(shared, schema)
        .select(
            "pivot",
            "key",
            F.shiftright("at", RANK_BITS).bitwiseAND(F.lit(ones)).cast("int").alias("n"),
            F.col("at").bitwiseAND(F.lit(ones)).cast("int").alias("rank"),
        )
    )


def may_meet(group: np.ndarray, n: np.ndarray, rank: np.ndarray, percent: int) -> np.ndarray:
    """Whether a row's region holds another one that sizes and its own rank allow a link with.

    With the pivot as first common shingle, at most 1 + (n - rank - 1) are common, which
    bounds the partner's size from above, as the sizes' ratio does from both sides.
    """
    if not len(n):
        return np.zeros(0, dtype=bool)
    wide = int(n.max()) + 2
    least = -(-percent * n // 100)
    most = np.minimum(100 * n // percent, (100 + percent) * (n - rank) // percent - n)
    most = np.clip(most, least - 1, wide - 1)
    sizes = np.sort(group * wide + n)
    met = np.searchsorted(sizes, group * wide + most, side="right")
    met -= np.searchsorted(sizes, group * wide + least, side="left")
    return met - (most >= n) > 0


def _sets(
    docs: DataFrame, points: DataFrame, pairs: DataFrame, k: int, kind: type = np.uint64
) -> DataFrame:
    """(key, set) of the points in ``pairs``; each set as the upper bits of its shingles.

    The sets are made anew, for the points of the pairs only: writing those of all
    documents would take more disk than the texts do.  The set of a text that stands in
    the table once has no second row anywhere and is written where it is made; only those
    of texts with copies are dealt out by key, to keep one of each.  A row too many, by
    collisions in the tables of bits, meets no pair.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    wanted = settle(points.join(ends, "key", "left_semi"), "wanted")
    bits = docs.sparkSession.sparkContext.broadcast(
        [
            mark_table(wanted, "id"),
            mark_table(wanted, "key"),
            mark_table(wanted.where("copied"), "key"),
        ]
    )
    shift = np.uint64(64 - 8 * np.dtype(kind).itemsize)

    def sets(batches):
        by_id, by_key, copied = bits.value
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            batch = batch.filter(pa.array(marked(by_id, ids)))
            for part in pieces(batch, "text", PIECE):
                found = shingle_sets(part.column("text"), k)
                keys = np.array([_key(s)[0] if len(s) else 0 for s in found], dtype=np.int64)
                there = marked(by_key, keys) & np.array([len(s) > 0 for s in found])
                found = [s for s, yes in zip(found, there.tolist()) if yes]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").filter(pa.array(there)),
                        pa.array(keys[there]),
                        pa.array([(s >> shift).astype(kind).tobytes() for s in found], pa.binary()),
                        pa.array(marked(copied, keys[there])),
                    ],
                    names=["id", "key", "set", "copied"],
                )

    made = docs.where("id is not null").mapInArrow(
        giving_back(sets), "id long, key long, set binary, copied boolean"
    )
    made = settle(made, "made")
    one = made.where("copied").drop("copied").join(wanted, ["id", "key"], "left_semi")
    one = settle(one.dropDuplicates(["id", "key"]).select("key", "set"), "sets")
    return made.where("not copied").select("key", "set").union(one)


def _common(left: list[bytes], right: list[bytes], kind) -> list[int]:
    """Sizes of the intersections of sorted arrays, as multisets."""
    out = []
    for x, y in zip(left, right):
        x, y = np.frombuffer(x, kind), np.frombuffer(y, kind)
        both = np.sort(np.concatenate([x, y]), kind="stable")
        if kind == np.uint64:  # sets: a value in both stands there twice
            out.append(int((both[1:] == both[:-1]).sum()))
        else:
            values, times = np.unique(x, return_counts=True)
            at = np.searchsorted(y, values)
            there = np.searchsorted(y, values, side="right") - at
            out.append(int(np.minimum(times, there).sum()))
    return out


def _with_common(pairs: DataFrame, sets: DataFrame, kind) -> DataFrame:
    """``pairs`` with ``common``, counted over the arrays in ``sets`` (key, set)."""
    rest = [c for c in pairs.columns if c not in ("a", "b")]

    def count(batches):
        for batch in batches:
            common = _common(
                batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), kind
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ["a", "b", *rest]] + [pa.array(common, pa.int64())],
                names=["a", "b", *rest, "common"],
            )

    both = pairs.join(sets.select(F.col("key").alias("a"), F.col("set").alias("set_a")), "a")
    both = both.join(sets.select(F.col("key").alias("b"), F.col("set").alias("set_b")), "b")
    both = both.select("a", "b", *rest, "set_a", "set_b")
    return both.mapInArrow(giving_back(count), more(both.select("a", "b", *rest).schema, "common long"))


def _measure(
    pairs: DataFrame, docs: DataFrame, points: DataFrame, k: int, percent: int | None = None
) -> DataFrame:
    """``pairs`` (a, b, na, nb) with ``common``, the size of the intersection.

    With ``percent``, pairs that cannot be linked are left out first, by 16 bits of every
    shingle: equal shingles have equal bits, so these have in common at least as much as
    the sets.  Whole sets are made for the pairs that are left.
    """
    pairs = settle(pairs, "pairs")
    if percent is not None:
        short = _sets(docs, points, pairs, k, np.uint16)
        pairs = _with_common(pairs, short, np.uint16).where(_linked(percent)).drop("common")
        pairs = settle(pairs, "likely")
    return _with_common(pairs, _sets(docs, points, pairs, k), np.uint64)


def _linked(percent: int) -> Column:
    return F.expr(f"100 * common >= {percent} * (na + nb - common)")


def _possible(percent: int, first: bool = True) -> str:
    """SQL: sizes and ranks in a common region still allow a link.

    ``first``: if the region's pivot is the first common shingle; else at most all those
    before the lower rank are common too.
    """
    most = "1L + least(na - ra - 1, nb - rb - 1)" + ("" if first else " + least(ra, rb)")
    return (
        f"100 * least(na, nb) >= {percent} * greatest(na, nb) "
        f"and {100 + percent} * ({most}) >= {percent} * (cast(na as long) + nb)"
    )


def _too_far(percent: int) -> str:
    """SQL: what two points share with a measured centre ``c`` rules out a link.

    They have in common at most the lesser of their parts inside the centre and the
    lesser of those outside.  This is the window of the triangle inequality, made
    narrower by the sizes; against the centre itself it is the exact test.
    """
    most = "least(sa[c], sb[c]) + least(na - sa[c], nb - sb[c])"
    return f"{100 + percent} * ({most}) < {percent} * (cast(na as long) + nb)"


def _least_met(percent: int) -> str:
    """SQL: the regions that two linked points share at least.

    Of their common shingles, at least ``least`` many, the j-th is behind at most j - 1
    common ones and n - least others of its set, and in a region if that is at most the
    window; so all are up to the one that fills the window of the larger set.
    """
    least = f"ceil({percent} * (cast(na as long) + nb) / {100 + percent} - 1e-9)"
    window = f"greatest(na - floor(na * {100 - percent} / 100), nb - floor(nb * {100 - percent} / 100))"
    return f"greatest(1 + {least} - {window}, 1)"


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    levels: int = LEVELS,
) -> DataFrame:
    """(id, text_hash, n_shingles, component_id, group): a row for every row of ``docs``.

    ``text_hash`` is Spark's xxhash64 of the text; ``group`` numbers the linked groups, and
    is null for documents without shingles.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("text_hash"),
    )
    profile = settle(_profile(rows, shingle), "profile")
    members = profile.where("slice is null").select("id", "text_hash", "n", "key", "key2")
    points = (
        members.where("id is not null and key is not null")
        .groupBy("key", "key2")
        .agg(F.min("id").alias("id"), (F.count(F.lit(1)) > 1).alias("copied"))
    )
    points = settle(points.select("id", "key", "copied"), "points")
    regions = settle(_regions(rows, points, _shingle_counts(profile), shingle, percent), "regions")

    links = tried = None
    here = regions.withColumn("home", F.col("key"))
    for level in range(levels):
        # Per region, the most central text of each part: few rarer shingles before the
        # region's.  The pivot is the most central of all, then that of a part outside.
        parts = here.withColumn("p", F.struct(F.expr("rank / n").alias("off"), "key", "n", "rank"))
        pick = F.min if level % 2 == 0 else F.max
        if pick is F.max:  # the least of all needs no least of each part
            parts = parts.groupBy("pivot", "home").agg(F.min("p").alias("p"))
        centre = (
            parts.groupBy("pivot")
            .agg(
                pick(F.struct("p", "home")).alias("c"),
                F.min("home").alias("low"), F.max("home").alias("high"),
            )
            .where("low != high")
            .select("pivot", "c.p", F.col("c.home").alias("p_home"))
        )
        near = (
            here.join(centre, "pivot")
            .where("home != p_home")
            .select(
                F.col("key").alias("a"), F.col("p.key").alias("b"), F.col("n").alias("na"),
                F.col("p.n").alias("nb"), F.col("rank").alias("ra"), F.col("p.rank").alias("rb"),
            )
        )
        # Those worth measuring now; whatever is passed over is met at the boundary.
        near = (
            near.where(_possible(percent, first=False))
            .groupBy("a", "b", "na", "nb")
            .agg(
                F.count(F.lit(1)).alias("met"),
                F.bool_or(F.expr(_possible(percent))).alias("possible"),
            )
            .where(f"possible and 2 * met >= {_least_met(percent)}")
            .groupBy("a", "na")
            .agg(F.max_by(F.struct("b", "nb"), F.struct("met", "b")).alias("p"))
            .select("a", "p.b", "na", "p.nb")
        )
        found = settle(_measure(near, rows, points, shingle), "measured")
        step = found.select(F.col("a").alias("key"), F.col("b").alias("centre"), "common")
        step = step.union(found.selectExpr("b", "b", "cast(nb as long)"))
        tried = step if tried is None else tried.union(step)
        new = found.where(_linked(percent)).select("a", "b")
        links = new if links is None else links.union(new)
        here = _at_home(regions, links)

    mixed = (
        here.groupBy("pivot")
        .agg(F.min("home").alias("low"), F.max("home").alias("high"))
        .where("low != high")
        .select("pivot")
    )
    last = tried.groupBy("key").agg(
        F.map_from_entries(F.collect_set(F.struct("centre", "common"))).alias("seen")
    )
    here = settle(here.join(mixed, "pivot", "left_semi").join(last, "key", "left"), "boundary")
    x, y = here.alias("x"), here.alias("y")
    apart = (
        x.join(
            y,
            F.expr(
                "x.pivot = y.pivot and x.key < y.key and x.home != y.home"
            ),
        )
        .selectExpr(
            "x.key as a", "y.key as b", "x.n as na", "y.n as nb", "x.rank as ra",
            "y.rank as rb", "x.seen as sa", "y.seen as sb",
        )
        .where(_possible(percent))  # the cheaper test first
        .where(f"not coalesce(exists(map_keys(sa), c -> {_too_far(percent)}), false)")
    )
    apart = apart.select("a", "b", "na", "nb").distinct()
    closing = _measure(apart, rows, points, shingle, percent)
    closing = closing.where(_linked(percent)).select("a", "b")
    closing = settle(closing, "closing")
    found = components(links.union(closing)).select(
        F.col("node").alias("key"), F.col("component").alias("home")
    )

    # The smallest id of each component, over all documents of all of its points.
    point = points.join(found, "key", "left").select(
        "key", "id", F.coalesce("home", "key").alias("home")
    )
    least = point.groupBy("home").agg(F.min("id").alias("component_id"))
    point = point.join(least, "home").select("key", "component_id", F.col("home").alias("group"))
    return members.join(point, "key", "left").select(
        "id",
        "text_hash",
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
        F.when(F.col("id").isNotNull(), F.col("group")).alias("group"),
    )


def _at_home(regions: DataFrame, links: DataFrame) -> DataFrame:
    """``regions`` with ``home``: the key's component under ``links``, or the key itself."""
    found = components(links).select(F.col("node").alias("key"), F.col("component").alias("home"))
    here = regions.join(settle(found, "homes"), "key", "left")
    return here.withColumn("home", F.coalesce("home", "key"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_components(docs).drop("text_hash", "group").withColumnRenamed("id", "doc_id")
