import math

import numpy as np
import pytest

from listinglake.llm import whitening as wh

def table_of(spark, rows, kind="float"):
    full = [(i, v, "n") for i, v in rows]
    return spark.createDataFrame(full, f"vec_id long, embedding array<{kind}>, n string").repartition(3)


def vectors(n=400, d=40, seed=1, kind=np.float32):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, d)) * np.geomspace(1, 0.02, d)
    mixed = (base @ np.linalg.qr(rng.standard_normal((d, d)))[0] + 0.3).astype(kind)
    return [(i, v.tolist()) for i, v in enumerate(mixed)]


def plain(rows, k=8):
    """What the contract says, with numpy's eigenvectors and whole numbers of any size."""
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(col) for col in zip(*x)]
    centred = np.array([[(n * c - t) / n for c, t in zip(v, s)] for v in x])
    cov = centred.T @ centred / n
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1][:k], vecs[:, ::-1][:, :k]
    dev = [sum((n * c - t) ** 2 for c, t in zip(v, s)) for v in x]
    return dev, centred @ vecs / np.sqrt(values), values / np.trace(cov)


def check(got, rows, k=8):
    dev, white, explained = plain(rows, k)
    ids = [i for i, _ in rows]
    by = {(r["vec_id"] if "vec_id" in r else r["id"], r["component"]): r for r in map(lambda r: r.asDict(), got)}
    assert len(by) == len(got) == len(rows) * k
    for j in range(k):
        mine = np.array([by[i, j + 1]["whitened"] for i in ids])
        theirs = white[:, j] * np.sign(white[:, j] @ mine)
        assert np.abs(mine - theirs).max() < 1e-8
        assert all(abs(by[i, j + 1]["explained"] / explained[j] - 1) < 1e-10 for i in ids)
    for i, d in zip(ids, dev):
        assert by[i, 1]["deviation"] == d and by[i, 1]["n"] == len(rows)
    assert all(r["identity_error"] < 1e-10 for r in by.values())


def test_query(spark, tmp_path):
    rows = vectors()
    odd = [
        (900, None), (901, []), (902, [1.0, 2.0]), (903, [None] * 40), (904, [float("nan")] * 40),
        (905, [0.0] * 39 + [float("inf")]), (906, [1.0] * 39 + [None]),
    ]
    table_of(spark, rows + odd).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = wh.op11_whitening(spark, str(tmp_path))
    assert got.columns[:7] == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error",
    ]
    check(got.collect(), rows)


def test_doubles_few_dimensions_and_other_names(spark):
    rows = vectors(60, 5, 3, np.float64)
    got = wh.whiten(table_of(spark, rows, "double"), components=3).collect()
    check(got, rows, 3)
    rows = vectors(30, 3, 4, np.float64)
    check(wh.whiten(table_of(spark, rows, "double")).collect(), rows, 3)


def test_large_entries_are_exact(spark):
    rows = [(i, [float(v) * 1e12, 1.0 + i % 3]) for i, v in enumerate([1, 5, 2, 9, 4, 4])]
    got = wh.whiten(table_of(spark, rows, "double"), components=1).collect()
    dev, _, _ = plain(rows, 1)
    assert {r["id"]: int(r["deviation"]) for r in got} == dict(enumerate(dev))
    # 1e200 fits no long: dropped like an infinite one.
    more = wh.whiten(table_of(spark, rows + [(99, [1e200, 0.0])], "double"), components=1)
    assert {r["id"] for r in more.collect()} == set(range(6))


def test_repeated_rows_and_ids(spark):
    rows = vectors(50, 6, 5, np.float64)
    twice = rows + rows[:10] + [(None, rows[3][1])]
    got = wh.whiten(table_of(spark, twice, "double"), components=2).collect()
    assert len(got) == 61 * 2 and {r["n"] for r in got} == {61}
    assert sum(r["id"] is None for r in got) == 2


def test_without_variance_there_are_no_components(spark):
    assert wh.whiten(table_of(spark, [])).count() == 0
    assert wh.whiten(table_of(spark, [(1, [0.5, 2.0])])).count() == 0
    assert wh.whiten(table_of(spark, [(1, [0.5, 2.0]), (2, [0.5, 2.0])])).count() == 0
    line = [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)]
    got = wh.whiten(table_of(spark, line, "double")).collect()
    assert len(got) == 9 and {r["component"] for r in got} == {1}


@pytest.mark.parametrize("gap", [0.5, 0.05, 0.003])
def test_filter_finds_vectors_beyond_small_gaps(gap):
    rng = np.random.default_rng(7)
    d = 120
    values = np.concatenate([1 + gap * np.arange(8, 0, -1), np.linspace(1, 0.2, d - 8)])
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    v = turn * values @ turn.T
    found = wh.leading(lambda q: v @ q, d, float(values.sum()), 8)
    assert np.allclose(found.values, values[:8], rtol=1e-12)
    assert np.abs(np.abs((turn[:, :8] * found.vectors).sum(axis=0)) - 1).max() < 1e-10
    assert found.residual < 1e-13


def test_a_wrong_start_does_not_hide_an_eigenvector():
    start = np.random.default_rng

    class Blind:  # the first block misses the largest eigenvector altogether
        def __init__(self):
            self.real = start(3)
            self.first = True

        def standard_normal(self, shape):
            out = self.real.standard_normal(shape)
            if self.first:
                out[0] = 0
                self.first = False
            return out

    values = np.concatenate([[9.0], np.linspace(3, 0.1, 79)])
    np.random.default_rng = lambda seed: Blind()
    try:
        found = wh.leading(lambda q: values[:, None] * q, 80, float(values.sum()), 4)
    finally:
        np.random.default_rng = start
    assert np.allclose(found.values, [9.0, *values[1:4]])
