"""Embedding whitening against dense linear algebra."""

from __future__ import annotations

import math

import numpy as np
import pytest

from ledgerline.llm.catalog import queries
from ledgerline.llm.whitening import WhitenSpec, fit_whitening, jacobi_davidson, minres, op11_embedding_whitening, summed_over_blocks, whiten
from tests.llm.samples import rows_of

DDL = "vec_id bigint, embedding array<float>, label int"


def vectors(spark, matrix, more=()):
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(matrix)]
    return spark.createDataFrame([*rows, *more], DDL).repartition(3)


def dense(matrix):
    x = np.floor(64 * matrix.astype(np.float32).astype(float))
    gap = x - x.mean(axis=0)
    values, basis = np.linalg.eigh(gap.T @ gap / len(x))
    return x, gap, values[::-1], basis[:, ::-1]


def check(found, matrix, ids):
    x, gap, values, basis = dense(matrix)
    whole = [[int(c) for c in row] for row in x]
    n, sums = len(whole), [sum(c) for c in zip(*whole, strict=True)]
    k = min(32, int((values > 1e-11 * values[0]).sum()))
    assert len(found) == n * k
    got = np.full((n, k), np.nan)
    for r in found:
        i, c = ids.index(r["vec_id"]), r["component"] - 1
        got[i, c] = r["whitened"]
        assert r["n"] == n and r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(whole[i], sums, strict=True))
        assert math.isclose(r["explained"], values[c] / values.sum(), rel_tol=1e-10) and r["identity_error"] < 1e-9
    want = gap @ basis[:, :k] / np.sqrt(values[:k])
    sign = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * sign).max() < 1e-8


def test_matches_dense_eigenvectors(spark):
    rng = np.random.default_rng(1)
    matrix = rng.standard_normal((400, 48)) * (0.9 ** np.arange(48)) + 3
    check(op11_embedding_whitening(vectors(spark, matrix)).collect(), matrix, list(range(400)))


def test_bad_vectors_and_fewer_dimensions(spark):
    rng = np.random.default_rng(2)
    matrix = np.vstack([rng.standard_normal((60, 5)), np.ones((30, 5))])  # a third are copies
    more = [(900, None, 1), (901, [1.0, None, 1.0, 1.0, 1.0], 1), (902, [], 1), (903, [float("nan")] * 5, 1),
            (904, [float("inf"), 0.0, 0.0, 0.0, 0.0], 1), (905, [1.0] * 4, 1), (906, [3e38, 0.0, 0.0, 0.0, 0.0], 1)]
    check(op11_embedding_whitening(vectors(spark, matrix, more)).collect(), matrix, list(range(90)))


def test_directions_without_variance_are_no_components(spark):
    rng = np.random.default_rng(3)
    base = np.round(rng.standard_normal((50, 2)) * 100)
    matrix = np.hstack([base, base[:, :1] + base[:, 1:], np.zeros((50, 1))])
    found = op11_embedding_whitening(vectors(spark, matrix)).collect()
    assert {r["component"] for r in found} == {1, 2}
    check(found, matrix, list(range(50)))


def test_equal_one_and_no_vectors(spark):
    for matrix in (np.ones((5, 4)), np.ones((1, 4)), np.zeros((0, 4))):
        out = op11_embedding_whitening(vectors(spark, matrix))
        assert out.collect() == []
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries_stay_exact_and_long_overflow_is_null(spark):
    matrix = np.array([[2.0 ** 20, 0.0], [0.0, 1.0], [3.0, 2.0 ** 20]])
    check(op11_embedding_whitening(vectors(spark, matrix)).collect(), matrix, [0, 1, 2])
    huge = vectors(spark, np.array([[2.0 ** 50, 0.0], [0.0, 1.0], [1.0, 2.0 ** 50]]))
    assert [r["deviation"] for r in op11_embedding_whitening(huge).collect()] == [None] * 6


def test_null_and_repeated_ids_and_clashing_columns(spark):
    rng = np.random.default_rng(4)
    df = vectors(spark, rng.standard_normal((20, 3)), [(None, [1.0, 2.0, 3.0], 1), (7, [1.0, 2.0, 3.0], 1)])
    for name in ("component", "n", "i", "v", "d", "rows", "data", "kind", "_vector", "whitened", "deviation"):
        df = df.selectExpr("*", f"'{name}' AS `{name}`")
    found = op11_embedding_whitening(df).collect()
    assert len(found) == 22 * 3 and sum(r["vec_id"] is None for r in found) == 3 and sum(r["vec_id"] == 7 for r in found) == 6
    model = fit_whitening(df, "embedding")
    assert whiten(df, "embedding", model, "extra").columns == [*df.columns, "extra"]


def test_sums_in_groups_equal_sums_on_the_driver(spark):
    y = np.arange(40, dtype=np.int8).reshape(20, 2)
    rows = [(1, y.dtype.str, y[i:i + 1].tobytes(), None) for i in range(20)]
    blocks = spark.createDataFrame(rows, "rows int, kind string, data binary, sums array<decimal(38,0)>").repartition(7)
    of_rows = lambda b: b.astype(float).T @ b
    for stored in (20, 5000):
        assert (summed_over_blocks(blocks, of_rows, 2, stored) == y.astype(float).T @ y).all()


@pytest.mark.parametrize(("dims", "values"), [
    (200, 100 * 0.97 ** np.arange(200)), (120, np.r_[np.full(40, 5.0), np.linspace(3, 1, 80)]), (90, np.ones(90)), (1, np.ones(1))])
def test_jacobi_davidson_reaches_rounding(dims, values):
    q, _ = np.linalg.qr(np.random.default_rng(5).standard_normal((dims, dims)))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    pairs = jacobi_davidson(lambda b: a @ b, dims, WhitenSpec())
    k = min(32, dims)
    assert np.abs(pairs.values - np.sort(values)[::-1][:k]).max() < 1e-11 * values.max()
    assert np.linalg.norm(a @ pairs.vectors - pairs.vectors * pairs.values, axis=0).max() < 1e-11 * values.max()
    assert np.abs(pairs.vectors.T @ pairs.vectors - np.eye(k)).max() < 1e-13


def test_minres_solves_projected_systems():
    rng = np.random.default_rng(6)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    q, _ = np.linalg.qr(rng.standard_normal((30, 4)))
    b = rng.standard_normal((30, 3))
    shifts = np.array([40.0, -35.0, 0.5])
    t = minres(lambda x: a @ x, shifts, q, b, 60)
    p = np.eye(30) - q @ q.T
    for i, s in enumerate(shifts):
        gap = p @ (a - s * np.eye(30)) @ t[:, i] - p @ b[:, i]
        assert np.linalg.norm(gap) < 2e-3 * np.linalg.norm(p @ b[:, i])


def test_query_over_the_whole_table(spark, sf_dir):
    out = rows_of(queries()["op11_embedding_whitening"](spark, sf_dir).groupBy("component").count())
    assert len(out) == 32 and len({n for _, n in out}) == 1
