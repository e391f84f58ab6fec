"""Whitening against numpy on the whole matrix."""

import numpy as np
import pytest

from tabwright.llm import whitening


def reference(v, k=8):
    x = np.floor(1024 * v.astype(float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    values, vectors = values[order], vectors[:, order]
    with np.errstate(divide="ignore", invalid="ignore"):
        white = centred @ vectors[:, :k] / np.sqrt(values[:k])
    deviation = [sum((n * int(c) - int(t)) ** 2 for c, t in zip(row, s)) for row in x]
    return n, deviation, white, values / values.sum()


def collect(df):
    rows = df.collect()
    k = max(r["component"] for r in rows)
    ids = sorted({r["vec_id"] for r in rows})
    white = np.zeros((len(ids), k))
    for r in rows:
        white[ids.index(r["vec_id"]), r["component"] - 1] = np.nan if r["whitened"] is None else r["whitened"]
    assert len({r["identity_error"] for r in rows}) == 1 and len(rows) == k * len(ids)
    return rows, ids, white


def same(got, want, tolerance=1e-8):
    for j in range(want.shape[1]):
        sign = np.sign(got[:, j] @ want[:, j])
        assert np.abs(got[:, j] - sign * want[:, j]).max() < tolerance


def test_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    pdf = vectors.orderBy("vec_id").toPandas()
    n, deviation, white, explained = reference(np.stack(pdf["embedding"]))
    rows, ids, got = collect(whitening.whiten(vectors.repartition(3)))
    assert ids == pdf["vec_id"].tolist()
    same(got, white)
    by_id = dict(zip(ids, deviation))
    for r in rows:
        assert r["n"] == n and r["deviation"] == by_id[r["vec_id"]] and r["identity_error"] < 1e-10
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)


@pytest.mark.parametrize("spread", [3, 9])
def test_ill_conditioned(spark, spread):
    """Widths over many orders of magnitude: the first Gram matrix is close to singular or beyond."""
    rng = np.random.default_rng(spread)
    turn = np.linalg.qr(rng.standard_normal((10, 10)))[0]
    v = (rng.standard_normal((700, 10)) * np.logspace(spread, 0, 10)) @ turn
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], "vec_id long, embedding array<double>")
    fit = whitening.fit_whitening(table)
    n, _, white, explained = reference(v)
    assert 2 <= fit.passes <= 4 and np.allclose(fit.components.T @ fit.components, np.eye(10), atol=1e-12)
    rows, _, got = collect(whitening.whiten(table, 5))
    same(got[:, :3], white[:, :3], 1e-6)
    assert rows[0]["identity_error"] < 1e-4


def test_few_directions(spark):
    """Constant dimensions and copies: components without variance have no coordinate."""
    rng = np.random.default_rng(2)
    base = rng.standard_normal((60, 2))
    v = np.column_stack([base, base.sum(axis=1), np.full(60, 0.5)])
    v = np.floor(v * 64) / 64
    v[:, 2] = v[:, 0] + v[:, 1]
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], "vec_id long, embedding array<double>")
    rows, _, got = collect(whitening.whiten(table))
    same(got[:, :2], reference(v, 2)[2])
    assert np.isnan(got[:, 2:]).all() and rows[0]["identity_error"] < 1e-10
    copies = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<double>")).collect()
    assert [(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in copies] == [(0, None, 0.0, 0.0)] * 10


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (1, [2.0, 1.0]), (None, [3.0, 0.5]), (3, None), (4, []), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, None]), (9, [0.0, 0.0]), (10, [1.0]), (11, [1e200, 0.0])]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, whitened string").repartition(3)
    out = whitening.whiten(table).collect()
    assert sorted(str(r["vec_id"]) for r in out) == sorted(["1"] * 4 + ["None"] * 2 + ["9"] * 2)
    assert {r["n"] for r in out} == {4} and out[0]["identity_error"] < 1e-12
    assert whitening.whiten(table.limit(0)).count() == 0
    large = spark.createDataFrame([(1, [3e9, 0.0]), (2, [0.0, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    want = reference(np.array([[3e9, 0.0], [0.0, 0.0], [0.0, 1.0]]), 2)[1]
    assert {r["vec_id"]: r["deviation"] for r in whitening.whiten(large).collect()} == {i + 1: d if d < 2**63 else None for i, d in enumerate(want)}
