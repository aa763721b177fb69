"""Whitening against a dense eigen-decomposition, with every kind of odd row."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywright.llm import whitening
from tallywright.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def expected(rows, components=32):
    """Per row and component: n, deviation, whitened up to sign, explained; by numpy on the whole table."""
    ids = [i for i, _ in rows]
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows], object)
    n, sums = len(x), x.sum(0)
    d = n * x - sums
    centred = d.astype(float) / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    keep = [k for k in range(min(components, len(e))) if e[k] > 1e-13 * e[0]] if e[0] > 0 else []
    y = centred @ u[:, keep] / np.sqrt(e[keep])
    return ids, n, [int((row**2).sum()) for row in d], y, e[keep] / e.sum()


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, x string, n string")


def check(found, model, rows, components=32):
    ids, n, deviations, y, shares = expected(rows, components)
    got = sorted((r.vec_id is not None, r.vec_id or 0, r.deviation, r.whitened) for r in found.collect())
    want = sorted(zip([i is not None for i in ids], [i or 0 for i in ids], deviations, y.tolist()))
    assert model.n == n and [g[:3] for g in got] == [w[:3] for w in want]
    a, b = np.array([g[3] for g in got]), np.array([w[3] for w in want])
    signs = np.sign((a * b).sum(0))
    assert np.abs(a - b * signs).max(initial=0) < 1e-7
    assert np.allclose(model.values / model.trace, shares, rtol=1e-9)
    assert model.identity_error < 1e-9


def test_registered_query_on_the_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    ids, n, deviations, y, shares = expected(rows)
    found = QUERIES["op11_whitening"](spark, SF).collect()
    assert len(found) == len(rows) * 32 and {r.n for r in found} == {n}
    of, where = dict(zip(ids, deviations)), {i: k for k, i in enumerate(ids)}
    assert all(r.deviation == of[r.vec_id] for r in found)
    a = np.zeros((n, 32))
    for r in found:
        a[where[r.vec_id], r.component - 1] = r.whitened
        assert abs(r.explained / shares[r.component - 1] - 1) < 1e-9
    assert np.abs(a - y * np.sign((a * y).sum(0))).max() < 1e-7
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9
    assert np.abs(np.cov(a.T, bias=True) - np.eye(32)).max() < 1e-9


def test_odd_rows_do_not_count(spark):
    rng = np.random.default_rng(5)
    good = [(i if i % 9 else None, [float(np.float32(v)) for v in rng.normal(size=6) * (1, 2, 3, 4, 5, 0)]) for i in range(60)]
    good += [good[3]] * 30  # one vector makes a third of the table
    odd = [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (103, [NAN] + [0.0] * 5), (104, [INF] * 6)]
    odd += [(105, [1.0, 2.0]), (106, [3e30] * 6), (107, [-INF] + [1.0] * 5)]
    df = vectors(spark, [(i, v, 1, "a", "b") for i, v in good + odd]).repartition(5)
    found, model = whitening.whiten(df)
    assert len(model.values) == 5  # the last column is constant
    check(found, model, good)
    found, model = whitening.whiten(df, 2)
    check(found, model, good, 2)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 0, "", "")], [(1, [1.0], 0, "", "")] * 4])
def test_without_variance_there_are_no_components(spark, rows):
    found, model = whitening.whiten(vectors(spark, rows))
    assert [(r.deviation, r.whitened) for r in found.collect()] == [(0, [])] * len(rows)
    assert model.n == len(rows) and model.identity_error == 0


def test_query_on_an_empty_table(spark, tmp_path):
    vectors(spark, []).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES["op11_whitening"](spark, str(tmp_path)).collect() == []


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [float(np.float32((-1) ** i * 1e11)), float(i)], 0, "", "") for i in range(20)]
    found, model = whitening.whiten(vectors(spark, rows))
    assert {r.deviation for r in found.collect()} == {None}
    assert len(model.values) == 1  # beside 1e11 the second column is rounding


def test_partial_sums_are_added_in_groups(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(size=4)]) for i in range(40)]
    df = vectors(spark, [(i, v, 1, "a", "b") for i, v in rows]).repartition(7)
    usable = whitening.whole_vectors(df)
    model = whitening.Whitening(usable)
    check(whitening.whitened(usable, model), model, rows)


@pytest.mark.parametrize("dim, gap", [(40, 1.0), (300, 1.0), (120, 0.0)])
def test_solver_reaches_double_precision(dim, gap):
    """Large spaces restart and lock; equal eigenvalues have no single vector, but a common space."""
    rng = np.random.default_rng(dim)
    q, _ = np.linalg.qr(rng.normal(size=(dim, dim)))
    e = np.sort(rng.uniform(1, 100, dim))[::-1]
    e[:3] = e[0] + gap * np.array([2, 1, 0])
    v = (q * e) @ q.T
    values, vectors_, residuals = whitening.jacobi_davidson(lambda b: v @ b, dim, 12)
    assert np.abs(values - e[:12]).max() < 1e-11 * e[0] and residuals.max() < 1e-12 * e[0]
    assert np.abs(vectors_.T @ vectors_ - np.eye(12)).max() < 1e-13
    outside = vectors_ - q[:, :12] @ (q[:, :12].T @ vectors_)
    assert np.abs(outside).max() < 1e-10


def test_minres_solves_an_indefinite_system():
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    a = (q * np.linspace(-3, 5, 12)) @ q.T
    b = np.hstack([rng.normal(size=(12, 2)), np.zeros((12, 1)), q[:, :1]])
    t = whitening.minres(lambda v, columns: a @ v, b, 14)
    assert np.abs(a @ t - b).max() < 1e-9
