"""Whitening against plain linear algebra and exact integers."""

import math
import random

import numpy as np
import pytest

from lakeferry.llm import eigen, whitening

SCHEMA = "vec_id long, embedding array<double>, component string, n string, parts string"


def matrix_of(values, seed=1):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    return (q * np.array(values, float)) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        [5.0, 3, 2, 1],
        [7.0],
        [2.0, 1],
        [1.0] * 6,
        [4.0, 4, 4, 1, 0, 0],
        [1e9, 1e9 - 1e-3, 5, 1e-9, 0],
        [0.0] * 5,
        [3.0, 1, -2, -8],
        list(np.linspace(1, 2, 40)),
        [1e-200, 1e-201, 0],
    ],
)
def test_leading_eigenvectors(values):
    matrix = matrix_of(values)
    n = min(4, len(values))
    found, rows = eigen.leading(matrix, n)
    scale = max(np.abs(values).max(), 1e-300)
    assert np.abs(found - np.sort(values)[::-1][:n]).max() <= 1e-13 * scale
    assert np.abs(rows @ rows.T - np.eye(n)).max() < 1e-12
    assert np.abs(matrix @ rows.T - rows.T * found).max() <= 1e-13 * scale


def test_matrices_that_are_tridiagonal_already():
    rng = np.random.default_rng(2)
    for matrix in (np.eye(5), np.diag([3.0, 1, 2]), np.zeros((3, 3)), np.array([[1.0, 2, 0], [2, 1, 3], [0, 3, 1]])):
        values, rows = eigen.leading(matrix, 3)
        assert np.allclose(matrix @ rows.T, rows.T * values, atol=1e-13) and np.allclose(rows @ rows.T, np.eye(3), atol=1e-12)
    a = rng.normal(size=(30, 30))
    diagonal, off, _ = eigen.tridiagonal(a + a.T)
    points = np.linspace(-20, 20, 50)
    want = [(np.linalg.eigvalsh(a + a.T) < p).sum() for p in points]
    assert eigen.counts_below(diagonal, off, points).tolist() == want


def brute(rows):
    """(x-vectors of the usable rows with their ids)."""
    sizes = [len(v) for _, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    size = max(set(sizes), key=lambda s: (sizes.count(s), s))
    return [
        (i, [math.floor(1024 * c) + 100000 for c in v])
        for i, v in rows
        if v and len(v) == size and all(c is not None and math.isfinite(c) for c in v)
    ]


def check(found, rows, components):
    usable = brute(rows)
    x = np.array([v for _, v in usable], float)
    n = len(usable)
    totals = [sum(v[d] for _, v in usable) for d in range(x.shape[1])]
    centred = x - x.mean(axis=0)
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    assert len(found) == n * components
    deviations = sorted((str(i), sum((n * c - s) ** 2 for c, s in zip(v, totals))) for i, v in usable)
    for k in range(1, components + 1):
        own = [r for r in found if r["component"] == k]
        assert sorted((str(r["vec_id"]), r["deviation"]) for r in own) == deviations
        assert {r["n"] for r in own} == {n}
        assert all(abs(r["explained"] - values[-k] / values.sum()) <= 1e-10 for r in own)
        assert len({r["identity_error"] for r in own}) == 1 and own[0]["identity_error"] <= 1e-9
        want = {}
        for (i, _), row in zip(usable, centred @ directions[:, -k] / np.sqrt(values[-k])):
            want.setdefault(i, []).append(row)
        got = {}
        for r in own:
            got.setdefault(r["vec_id"], []).append(r["whitened"])
        at = max(want, key=lambda i: abs(want[i][0]))
        sign = 1 if (max(want[at]) > 0) == (max(got[at]) > 0) else -1
        for i, values_ in want.items():
            assert np.allclose(sorted(sign * v for v in got[i]), sorted(values_), atol=1e-8)


def test_whitened(spark):
    rng = random.Random(4)
    spread = [3.0, 2.0, 1.5, 1.0, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1]
    rows = [(i, [rng.gauss(0, s) for s in spread]) for i in range(300)]
    rows += [(300, None), (301, []), (302, [1.0, 2.0]), (303, [0.1] * 9 + [None]), (304, [float("nan")] + [0.0] * 9), (305, [float("inf")] * 10)]
    rows += [rows[0], rows[0], (rows[1][0], rows[2][1]), (None, rows[3][1]), (None, None), (306, [0.0] * 10)]
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).repartition(5)
    found = whitening.whitened(df).collect()
    assert list(found[0].asDict()) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(found, rows, 8)
    check(whitening.whitened(df, 3).collect(), rows, 3)


def test_few_dimensions_and_no_variance(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = whitening.whitened(df).collect()
    assert len(found) == 80
    second = [r for r in found if r["component"] == 2]
    assert all(r["whitened"] is None and r["explained"] == 0 and r["identity_error"] < 1e-12 for r in second)
    same = spark.createDataFrame([(1, [2.0, 3.0])] * 3, "vec_id long, embedding array<double>")
    got = whitening.whitened(same).collect()
    assert len(got) == 6 and all(r["deviation"] == 0 and r["whitened"] is None and r["identity_error"] is None for r in got)


def test_large_entries(spark):
    rows = [(0, [1e300, 0.0]), (1, [-1e300, 0.5]), (2, [3.0, 1.0]), (3, [1e12, 7.0])]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 8 and {r["vec_id"] for r in got if r["deviation"] is None} == {0, 1, 2, 3}
    rows = [(i, [float(2**40 + i)]) for i in range(3)]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(r["deviation"] for r in got) == [0, (3 * 1024) ** 2, (3 * 1024) ** 2]


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whitened(none).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, None)], none.schema)).columns[-1] == "identity_error"
