"""Whitening against a dense eigensolver, the solver's parts, and edge cases."""

import math

import numpy as np
import pytest

from finlake.llm import common, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(vectors, size):
    """(n, deviations, whitened up to sign, explained) by numpy.linalg.eigh over the distinct whole vectors."""
    x = np.full((len(vectors), size), whitening.SHIFT, np.int64)
    for k, v in enumerate(vectors):
        x[k, : len(v)] = [math.floor(64 * float(c)) + whitening.SHIFT for c in v]
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = (n * fit - total) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1][:16], basis[:, ::-1][:, :16]
    apart = n * x - total
    return n, (apart**2).sum(axis=1), (apart / n) @ basis / np.sqrt(values), values / (centred**2).sum() * n


def test_query_equals_dense_solver(spark):
    got = whitening.op11_whitening(spark, SF).toPandas().sort_values(["vec_id", "component"])
    rows = {r.vec_id: r.embedding for r in common.read_table(spark, SF, "embeddings").collect()}
    ids = sorted(rows)
    n, deviation, whitened, explained = expected([rows[i] for i in ids], 64)
    assert got.vec_id.tolist() == [i for i in ids for _ in range(16)] and set(got.n) == {n}
    assert got.deviation.tolist() == [d for d in deviation.tolist() for _ in range(16)]
    found = got.whitened.to_numpy().reshape(len(ids), 16)
    signs = np.sign((found * whitened).sum(axis=0))
    assert np.abs(found * signs - whitened).max() < 1e-9
    assert np.abs(got.explained.to_numpy().reshape(len(ids), 16) / explained - 1).max() < 1e-12
    assert got.identity_error.max() < 1e-10 and got.residual.max() < 1e-13


@pytest.mark.parametrize("size,count", [(5, 16), (40, 6), (300, 8)])
def test_solver_on_matrices_larger_than_its_space(size, count):
    rng = np.random.default_rng(size)
    turn, _ = np.linalg.qr(rng.standard_normal((size, size)))
    values = np.sort(rng.random(size) ** 3)[::-1] * 50
    values[1:3] = values[1]  # an eigenvalue of two dimensions
    matrix = (turn * values) @ turn.T
    passes = []

    def product(v):
        passes.append(v.shape[1])
        return matrix @ v

    found, vectors, residual = whitening.leading_pairs(product, size, count)
    k = min(size, count)
    assert np.abs(found - values[:k]).max() < 1e-12 * values[0] and residual < 1e-13
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13
    # Far fewer columns than the matrix has would be multiplied by forming it.
    assert size < 100 or sum(passes) < 40 * size


def test_minres_solves_shifted_systems_in_step():
    rng = np.random.default_rng(1)
    half = rng.standard_normal((30, 30))
    matrix, shift = half + half.T, np.array([0.3, -1.0, 2.0])
    right = rng.standard_normal((30, 3))
    found = whitening.minres(lambda t: matrix @ t - t * shift, right, 200)
    assert np.abs(matrix @ found - found * shift - right).max() < 1e-7
    assert not whitening.minres(lambda t: matrix @ t, np.zeros((30, 2)), 5).any()


def test_repeats_nulls_ragged_and_equal_rows(spark):
    rng = np.random.default_rng(3)
    base = [rng.standard_normal(6).tolist() for _ in range(30)]
    good = [*[(k, v) for k, v in enumerate(base)], (3, base[3]), (None, base[4]), (99, base[5]), (100, base[6][:4]), (101, [])]
    bad = [(200, None), (201, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (202, [math.nan] * 6), (203, [math.inf] * 6)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in [*good, *bad]], SCHEMA)
    got = whitening.whiten(frame.withColumnRenamed("label", "whitened")).toPandas()
    vectors = [np.float32(v) for _, v in good]
    n, deviation, whitened, _ = expected(vectors, 6)
    assert n == 32 and set(got.n) == {n} and len(got) == len(good) * 6
    assert got.vec_id.isna().sum() == 6 and set(got.vec_id.dropna()) == {i for i, _ in good if i is not None}
    twice = got[got.vec_id == 3].groupby("component").whitened.nunique()
    assert (twice == 1).all()
    for (i, _), d, w in zip(good, deviation.tolist(), whitened, strict=True):
        own = got[got.vec_id == i].drop_duplicates("component") if i is not None else got[got.vec_id.isna()]
        assert {int(x) for x in own.deviation} == {d}
        assert np.abs(np.abs(own.sort_values("component").whitened.to_numpy()) - np.abs(w)).max() < 1e-9


def test_no_variance_gives_no_components(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).count() == 0
    # One direction varies: one component, whitened to unit variance.
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 5.0], 0) for k in range(10)], SCHEMA)
    got = whitening.whiten(line).toPandas()
    assert len(got) == 10 and abs(got.whitened.pow(2).mean() - 1) < 1e-12 and abs(got.explained[0] - 1) < 1e-12


def test_large_entries_are_exact_and_too_large_ones_raise(spark):
    schema = SCHEMA.replace("float", "double")
    rows = [(1, [2.0**49, 1.0]), (2, [-(2.0**49), 2.0]), (3, [0.5, 3.0])]
    got = whitening.whiten(spark.createDataFrame([(*r, 0) for r in rows], schema), components=1).collect()
    x = [[int(64 * c) + whitening.SHIFT for c in v] for _, v in rows]
    want = {i: sum((3 * a - sum(r[k] for r in x)) ** 2 for k, a in enumerate(v)) for (i, _), v in zip(rows, x, strict=True)}
    assert {r.vec_id: int(r.deviation) for r in got} == want
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [2.0**60], 0), (2, [0.0], 0)], schema)).count()
