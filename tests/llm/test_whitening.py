"""Operator 12 against numpy's dense eigensolver and exact integers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from tidemark.llm import whitening
from tidemark.llm.common import prepare
from tidemark.llm.whitening import above, components, feast, grid_vectors, intervals, moments, whiten

SCHEMA = "vec_id long, embedding array<double>"


def brute(vectors, wanted=16):
    """Components by numpy, moments by Python integers."""
    x = [[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, x))), object)
    n, s = len(fit), fit.sum(axis=0)
    t = n * fit - s
    cov = np.array((t.T.dot(t)), object)
    cov = np.array([[float(c / n ** 3) if c else 0.0 for c in row] for row in cov])
    value, vector = np.linalg.eigh(cov)
    order = np.argsort(-value)[:wanted]
    dev = [int(((n * np.array(r, object) - s) ** 2).sum()) for r in x]
    centred = np.array([[float(c) / n for c in n * np.array(r, object) - s] for r in x])
    return n, dev, value[order], centred @ (vector[:, order] / np.sqrt(value[order])), value[order] / np.trace(cov)


def check(rows, vectors, wanted=16):
    n, dev, value, z, share = brute(vectors, wanted)
    assert len(rows) == len(vectors) * len(value)
    got = np.full(z.shape, np.nan)
    for r in rows:
        assert r.n == n and r.deviation == dev[r.vec_id] and r.identity_error < 1e-9
        assert r.explained == pytest.approx(share[r.component - 1], rel=1e-9)
        got[r.vec_id, r.component - 1] = r.whitened
    sign = np.sign((got * z).sum(axis=0))
    assert np.abs(got - sign * z).max() < 1e-7


def test_whole_table(spark):
    prepare(spark)
    df = spark.read.parquet(f"{SF0001}/embeddings.parquet")
    vectors = [r.embedding for r in df.orderBy("vec_id").collect()]
    check(whiten(df).collect(), vectors)


@pytest.mark.parametrize("seed, d, n", [(0, 3, 40), (1, 20, 300), (2, 24, 10)])
def test_random_vectors_with_copies(spark, seed, d, n):
    prepare(spark)
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, d)) * np.linspace(9, 0.5, d) + 3
    v = np.concatenate([v, v[:1].repeat(n, axis=0)])  # a third and more are copies of one
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], SCHEMA).repartition(3)
    wanted = min(16, d, n - 1)
    check(whiten(df.withColumns({"n": F.lit(1), "z": F.lit("x"), "_x": F.lit(0)})).collect(), v, wanted)


def test_rows_left_out(spark):
    prepare(spark)
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [3.0, 1.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 0.0]), (6, []),
            (7, [1.0]), (8, [1e300, 0.0]), (None, [5.0, 9.0]), (1, [3.0, 1.0])]
    out = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    ids = sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in out)
    assert ids == [(False, 0, 1), (False, 0, 2), (False, 1, 1), (False, 1, 1), (False, 1, 2), (False, 1, 2),
                   (True, 0, 1), (True, 0, 2)]
    assert {r.n for r in out} == {3}


def test_nothing_to_whiten(spark):
    prepare(spark)
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_large_entries_stay_exact(spark):
    prepare(spark)
    v = [[2.0 ** 50, 1.0], [-2.0 ** 50, 7.0], [3.0, -2.0 ** 48], [0.5, 0.25]]
    df = spark.createDataFrame(list(enumerate(v)), SCHEMA)
    m = moments(grid_vectors(df, "vec_id", "embedding").select("_x").distinct())
    _, _, value, _, _ = brute(v)
    assert np.allclose(np.linalg.eigvalsh(m.cov)[::-1], value, rtol=1e-12)
    assert {r.deviation for r in whiten(df).collect()} == {None}


def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(3)
    for d in (1, 2, 7, 30):
        a = rng.standard_normal((d, d))
        a = a + a.T
        e = np.linalg.eigvalsh(a)
        for s in [*((e[1:] + e[:-1]) / 2), e[0] - 1, e[-1] + 1, 0.1]:
            assert above(a, s) == (e > s).sum()
    assert above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


@pytest.mark.parametrize("values", [
    [5.0] * 9 + [1.0] * 5,                       # two clusters larger than an interval
    [10.0 ** -k for k in range(14)],             # fourteen orders of magnitude
    [1 + 1e-6 * k for k in range(30)],           # close together
    list(range(1, 41)),
])
def test_feast_finds_every_eigenpair(spark, values):
    d = len(values)
    q, _ = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    want = np.sort(np.linalg.eigvalsh(a))[::-1]
    parts, k = intervals(a, 16)
    assert k == min(16, d, (want > 8 * whitening.EPS * d * a.trace()).sum())
    for lo, hi, inside in parts:
        value, vector = feast(a, lo, hi, inside)
        assert len(value) == inside == ((want > lo) & (want <= hi)).sum()
    value, vector = components(spark, a, 16)
    assert np.allclose(value, want[:k], rtol=1e-12, atol=1e-13 * want[0])
    assert np.abs(vector.T @ vector - np.eye(k)).max() < 1e-13
    assert np.abs(a @ vector - vector * value).max() < 1e-13 * want[0]


def test_missing_eigenvalues_are_an_error():
    with pytest.raises(ArithmeticError):
        feast(np.diag([1.0, 2.0, 3.0, 9.0]), 0.5, 3.5, 4)
