import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from brookmart.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>"


def slow(vectors, counted=False):
    """x, n, S, eigenvalues and vectors (falling) by numpy over the fit list."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors])
    fit = x if counted else np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    z = (n * fit - s) / n
    v = z.T @ z / n
    e, q = np.linalg.eigh(v)
    return x, n, s, e[::-1], q[:, ::-1], v


def table_of(df):
    return {(r.vec_id, r.component): r for r in df.collect()}


@pytest.mark.parametrize("counted", [False, True])
def test_as_by_numpy(spark, counted):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(400, 24)) * np.linspace(2, 0.2, 24)).round(1)
    vectors[50:200] = vectors[7]  # a hot vector
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], SCHEMA).repartition(6)
    got = table_of(W.whiten(df, counted=counted))
    x, n, s, e, q, v = slow(vectors.tolist(), counted)
    assert len(got) == 400 * 16 and {r.n for r in got.values()} == {n}
    far = ((n * x - s) ** 2).sum(axis=1)
    white = (x - s / n) @ q[:, :16] / np.sqrt(e[:16])
    for k in range(16):
        mine = np.array([got[i, k + 1].whitened for i in range(400)])
        sign = np.sign(mine @ white[:, k])
        assert np.abs(mine * sign - white[:, k]).max() < 1e-6
        assert abs(got[0, k + 1].explained / (e[k] / np.trace(v)) - 1) < 1e-9
    assert [got[i, 1].deviation for i in range(400)] == far.tolist()
    assert {r.identity_error for r in got.values()} == {got[0, 1].identity_error} and got[0, 1].identity_error < 1e-9
    assert {got[i, 3].n_rows for i in range(400)} >= {150 + 1}


def test_small_table_by_fractions(spark):
    vectors = [[0.5, -0.25], [0.0, 1.0], [0.0, 1.0], [-1.5, 0.001], [0.49999, -0.25]]
    got = table_of(W.whiten(spark.createDataFrame(list(enumerate(vectors)), SCHEMA)))
    x, n, s, *_ = slow(vectors)
    assert n == 4 and sorted(got) == [(i, k) for i in range(5) for k in (1, 2)]
    for i in range(5):
        assert got[i, 1].deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[i], s))
        # all components together give the Mahalanobis distance
        v = [[sum(Fraction(int(p[a] * n - s[a]) * int(p[b] * n - s[b]), n ** 3) for p in np.unique(x, axis=0))
              for b in (0, 1)] for a in (0, 1)]
        d = [Fraction(int(x[i][a] * n - s[a]), n) for a in (0, 1)]
        det = v[0][0] * v[1][1] - v[0][1] ** 2
        want = (v[1][1] * d[0] ** 2 - 2 * v[0][1] * d[0] * d[1] + v[0][0] * d[1] ** 2) / det
        assert abs(got[i, 1].whitened ** 2 + got[i, 2].whitened ** 2 - float(want)) < 1e-9


def test_odd_vectors(spark):
    good = [(1, [0.1, 0.9]), (2, [0.7, 0.3]), (3, [0.2, -0.4]), (3, [0.2, -0.4]), (None, [0.5, 0.5])]
    bad = [(10, None), (11, []), (12, [None, 1.0]), (13, [float("nan"), 1.0]), (14, [float("-inf"), 1.0])]
    other = [(20, [0.1, 0.2, 0.3]), (21, [0.5, 0.1, -0.7])]
    df = spark.createDataFrame(good + bad + other, SCHEMA).withColumns(
        {n: F.lit("x") for n in ("x", "h1", "dims", "a.b", "n")})
    got = W.whiten(df).collect()
    # two vectors of length three have one direction
    assert sorted(((r.vec_id, r.component) for r in got), key=repr) == sorted(
        [(i, k) for i, _ in good for k in (1, 2)] + [(20, 1), (21, 1)], key=repr)
    assert {r.n for r in got if r.vec_id in (20, 21)} == {2} and {r.n for r in got if r.vec_id in (1, 3)} == {4}
    assert W.whiten(df.limit(0)).collect() == []
    assert W.whiten(spark.createDataFrame([(1, [0.1, 0.2]), (2, [0.1, 0.2])], SCHEMA)).collect() == []


def test_huge_entries_are_exact_or_null(spark):
    rows = [(1, [2.0 ** 45, 0.0]), (2, [-2.0 ** 45, 1.0]), (3, [1.0, 2.0]), (4, [1e300, 2.0]), (5, [2.0 ** 46, 2.0])]
    got = table_of(W.whiten(spark.createDataFrame(rows, SCHEMA)))
    x, n, s, *_ = slow([r[1] if abs(r[1][0]) < 1e50 else [2.0 ** 46, r[1][1]] for r in rows])
    for i, row in enumerate(x.tolist(), 1):
        want = sum((n * a - int(b)) ** 2 for a, b in zip(row, s))
        assert got[i, 1].deviation == (want if want < 1 << 63 else None)
        assert got[i, 1].deviation_wide == want
