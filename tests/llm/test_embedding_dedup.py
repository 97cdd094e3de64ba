"""Near-equal vectors: recall where it is hard, repeated ids, entries of any size."""

import numpy as np
import pytest

from listinglake.llm import embedding_dedup as ed


def linked(spark, rows, kind="double"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    return ed.link_vectors(df).collect()


def brute(rows, threshold=0.95):
    """n_links per row and the least id of its component; rows of distinct vectors."""
    x = np.array([v for _, v in rows])
    x = x / np.abs(x).max(1, keepdims=True)
    x /= np.sqrt((x**2).sum(1, keepdims=True))
    near = x @ x.T >= threshold
    home = np.arange(len(x))
    while True:
        after = np.array([home[near[i]].min() for i in range(len(x))])
        if (after == home).all():
            break
        home = after
    ids = np.array([i for i, _ in rows])
    least = [int(ids[home == h].min()) for h in home]
    return (near.sum(1) - 1).tolist(), least


def clustered(seed, n, d, common, spread):
    rng = np.random.default_rng(seed)
    shared = rng.standard_normal(d)
    shared /= np.sqrt(shared @ shared)
    centres = rng.standard_normal((n // 3, d)) / np.sqrt(d) + common * shared
    x = centres[rng.integers(0, len(centres), n)] + spread * rng.standard_normal((n, d)) / np.sqrt(d)
    return [(i, v.tolist()) for i, v in enumerate(x)]


@pytest.mark.parametrize("d,common,spread", [(64, 1.7, 0.42), (64, 0.0, 0.22), (128, 1.2, 0.35), (24, 1.0, 0.2)])
def test_recall_holds_with_a_common_direction(spark, d, common, spread):
    rows = clustered(d, 1500, d, common, spread)
    want, _ = brute(rows)
    got = {r["id"]: r["n_links"] for r in linked(spark, rows)}
    found = [got[i] for i, _ in rows]
    assert sum(want) > 500
    assert all(a <= b for a, b in zip(found, want))
    assert sum(found) >= 0.9 * sum(want)


def test_more_rotations_where_one_finds_too_few():
    rows = clustered(1, 1500, 64, 1.7, 0.42)
    unit = ed._unit([v for _, v in rows])
    tools, most = ed.choose_tools(unit, 0.95, 1)
    assert 1 < len(tools) <= ed.MOST_ROTATIONS and most >= ed.MOST_BITS


def test_rows_that_repeat_an_id_with_another_vector(spark):
    rng = np.random.default_rng(3)
    far = [(10 + i, rng.standard_normal(32).tolist()) for i in range(40)]
    a, b = far[0][1], far[1][1]
    near_a = (np.array(a) + 0.01).tolist()
    rows = [(1, a), (1, b), (2, near_a), (2, near_a), *far[2:]]
    got = linked(spark, rows)
    assert len(got) == len(rows)
    seen = sorted((r["id"], r["n_links"], r["component_id"], r["kept"]) for r in got if r["id"] < 10)
    # Vector b of id 1 is linked with nothing, whatever its other vector is.
    assert seen == [(1, 0, 1, True), (1, 1, 1, True), (2, 1, 1, False), (2, 1, 1, False)]


def test_entries_of_any_size(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((30, 16))
    scale = [1e200, 1e-200, 1.0]
    rows = [(3 * i + j, (v * s).tolist()) for i, v in enumerate(base) for j, s in enumerate(scale)]
    want, least = brute(rows)
    got = {r["id"]: (r["n_links"], r["component_id"]) for r in linked(spark, rows)}
    assert [got[i] for i, _ in rows] == list(zip(want, least))


def test_unusable_vectors_and_lengths(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, None), (2, []), (3, [0.0] * 3), (4, [1.0, None, 2.0]), (5, [float("nan")] * 3), (6, v), (7, v), (8, v[:2]), (None, v)]
    got = sorted(((r["id"], r["n_links"], r["component_id"], r["kept"]) for r in linked(spark, rows)), key=str)
    want = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 8)] + [(6, 1, 6, True), (7, 1, 6, False), (None, 0, None, True)]
    assert got == sorted(want, key=str)
    assert linked(spark, []) == []
