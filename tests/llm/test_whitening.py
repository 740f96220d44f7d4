"""Whitening against dense linear algebra and exact integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from premiumlake.llm import whitening
from premiumlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(vectors: list[list[float]], k: int = 4):
    """(x rows, n, S, eigenvalues, components as columns, trace) by a dense covariance."""
    x = [[math.floor(256 * c) for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, x))), float)
    centred = fit - fit.mean(0)
    covariance = centred.T @ centred / len(fit)
    values, basis = np.linalg.eigh(covariance)
    total = [sum(int(v) for v in column) for column in fit.T]
    return x, len(fit), total, values[::-1][:k], basis[:, ::-1][:, :k], np.trace(covariance)


def check(rows, vectors: dict, k: int = 4):
    x, n, total, values, basis, trace = brute(list(vectors.values()), k)
    by = {(r.vec_id, r.component): r for r in rows}
    assert set(by) == {(i, c) for i in vectors for c in range(1, k + 1)} and len(by) == len(rows)
    sign = {}
    for i, row in zip(vectors, x):
        for c in range(1, k + 1):
            r = by[i, c]
            assert r.n == n
            assert int(r.deviation) == sum((n * a - s) ** 2 for a, s in zip(row, total))
            assert r.explained == pytest.approx(values[c - 1] / trace, rel=1e-10)
            want = (np.array(row) - np.array(total) / n) @ basis[:, c - 1] / math.sqrt(values[c - 1])
            if abs(want) > 1e-3:
                sign.setdefault(c, math.copysign(1, want * r.whitened))
            assert sign.get(c, 1) * r.whitened == pytest.approx(want, abs=1e-8)
            assert r.identity_error <= 1e-8
    assert len({r.identity_error for r in rows}) == 1


def test_query_equals_dense_algebra(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    got = QUERIES["op12_whitening"](spark, SF)
    assert dict(got.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
        "whitened": "double", "explained": "double", "identity_error": "double",
    }
    check(got.collect(), vectors)


def test_odd_rows(spark):
    random = np.random.default_rng(3)
    scale = np.array([9, 7, 5, 3, 1, 0.5])
    good = {i: (random.standard_normal(6) * scale).tolist() for i in range(60)}
    good |= {100: good[0], 101: good[0], 102: [-0.0] * 6, 103: [1e-9] * 6}  # repeats, and equal once floored
    rows = [(i, v, "x", 1) for i, v in good.items()]
    rows += [(200, None, "x", 1), (201, [1.0, None, 2.0, 3.0, 4.0, 5.0], "x", 1), (202, [float("nan")] * 6, "x", 1)]
    rows += [(203, [float("inf")] + [0.0] * 5, "x", 1), (204, [1.0, 2.0], "x", 1), (205, [], "x", 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string, n long").repartition(5)
    check(whitening.whiten(frame).collect(), good)
    null_ids = spark.createDataFrame([(None, v) for v in good.values()], "vec_id long, embedding array<float>")
    got = whitening.whiten(null_ids, components=2)
    assert got.count() == 2 * len(good) and got.where("vec_id is null").count() == got.count()


def test_no_vectors_and_no_variance(spark):
    schema = "vec_id string, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([("a", None), ("b", [])], schema)).collect() == []
    same = whitening.whiten(spark.createDataFrame([("a", [1.0, 2.0])] * 5, schema))
    assert same.collect() == [] and same.columns[0] == "vec_id"
    line = whitening.whiten(spark.createDataFrame([("a", [1.0, 2.0]), ("b", [2.0, 4.0]), ("b", [2.0, 4.0])], schema)).collect()
    assert [r.component for r in line] == [1, 1, 1] and all(abs(abs(r.whitened) - 1) < 1e-12 for r in line)


def test_large_entries_stay_exact(spark):
    vectors = {i: [float(1 << 45) * (i % 7 + 1), float(i), 3.0 * (i % 5), -float(1 << 40) * i] for i in range(30)}
    rows = whitening.whiten(spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>"), components=2).collect()
    x, n, total, *_ = brute(list(vectors.values()))
    want = {i: sum((n * a - s) ** 2 for a, s in zip(row, total)) for i, row in zip(vectors, x)}
    assert {r.vec_id: int(r.deviation) for r in rows} == want


@pytest.mark.parametrize("spectrum", [[5, 5, 5, 4, 4, 1], [1e6, 1e6 - 1, 1, 1, 1e-6, 0], [3, 0, 0, 0, 0, 0]])
def test_solver_on_ties_gaps_and_low_rank(spectrum):
    """Ties, near ties, and fewer directions of variance than wanted, in 40 dimensions."""
    d = 40
    turn = np.linalg.qr(np.random.default_rng(7).standard_normal((d, d)))[0]
    values = np.sort(np.array(spectrum + [spectrum[-1] / 2] * (d - len(spectrum))))[::-1]
    matrix = (turn * values) @ turn.T
    found, basis = whitening.jacobi_davidson(lambda y: matrix @ y, d, 4)
    assert np.allclose(found, values[:4], rtol=1e-12, atol=1e-12 * values[0])
    assert np.linalg.norm(matrix @ basis - basis * found) <= 1e-12 * values[0]
    assert np.allclose(basis.T @ basis, np.eye(4), atol=1e-13)


def test_solver_says_when_it_fails():
    with pytest.raises(whitening.NotConverged):
        noise = np.random.default_rng(1)
        whitening.jacobi_davidson(lambda y: y * np.arange(50)[:, None] + noise.standard_normal(y.shape), 50, 2, whitening.Solver(rounds=12, space=20))
