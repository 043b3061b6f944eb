"""Whitening against eigenvectors of the plain covariance."""

import math

import numpy as np
import pytest

from lexiquarry.llm import whitening as wh


def table(spark, rows):
    return spark.createDataFrame([(i, v, 5, "k") for i, v in rows], "vec_id long, embedding array<float>, n int, component string").repartition(3)


def plain(vectors):
    """(x as Python integers, mean-free rows, eigenvalues and vectors by falling eigenvalue)."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n = len(x)
    sums = [sum(r[j] for r in x) for j in range(len(x[0]))]
    centred = np.array([[(n * r[j] - sums[j]) / n for j in range(len(r))] for r in x])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    return x, sums, centred, e[::-1], u[:, ::-1]


def usable(rows):
    return [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]


@pytest.mark.parametrize("dim, n, offset", [(3, 40, 0.0), (40, 300, 0.0), (5, 60, 3e7), (70, 200, 2.0)])
def test_equals_the_plain_version(spark, dim, n, offset):
    made = np.random.default_rng(dim)
    points = offset + made.normal(size=(n, dim)) @ made.normal(size=(dim, dim)) * np.logspace(1, -0.5, dim)
    rows = [(i, p.astype(np.float32).tolist()) for i, p in enumerate(points)]
    odd = [(900, None), (901, []), (902, [None] * dim), (903, [float("nan")] * dim), (904, [float("inf")] + [0.0] * (dim - 1)),
           (905, [1.0] * (dim + 1)), (906, [3e38] * dim)]
    rows += [(7, rows[7][1]), (None, rows[8][1])]
    docs = table(spark, rows + odd)
    found = wh.whiten(docs, wh.fit_whitening(docs)).collect()
    x, sums, centred, e, u = plain([v for _, v in rows])
    k = min(32, dim)
    assert len(found) == len(rows) * k and {r.n for r in found} == {len(rows)}
    assert found[0].identity_error <= 1e-8 and len({r.identity_error for r in found}) == 1
    deviation = {}
    for (i, _), r in zip(rows, x, strict=True):
        deviation[i] = sum((len(rows) * c - s) ** 2 for c, s in zip(r, sums, strict=True))
    assert all(r.deviation == (deviation[r.vec_id] if deviation[r.vec_id] < 2**63 else None) for r in found)
    got = {(r.vec_id, r.component): r.whitened for r in found}
    for c in range(k):
        want = centred @ u[:, c] / math.sqrt(e[c])
        ours = np.array([got[i, c + 1] for i, _ in rows])
        assert min(np.abs(ours - want).max(), np.abs(ours + want).max()) < 1e-6
        shares = [r.explained for r in found if r.component == c + 1]
        assert shares[0] == pytest.approx(e[c] / e.sum(), rel=1e-9)


def test_dependent_dimensions_are_left_out(spark):
    made = np.random.default_rng(1)
    base = made.integers(-500, 500, (80, 4)) / 64
    points = np.hstack([base, base[:, :2], base[:, 2:3] + base[:, 3:4], np.full((80, 2), 7.0)])
    docs = table(spark, [(i, p.tolist()) for i, p in enumerate(points)])
    fitted = wh.fit_whitening(docs)
    assert fitted.weights.shape == (9, 4) and fitted.identity_error < 1e-9


def test_few_rows_far_out(spark):
    """Sums and deviations stay exact where n times a number leaves 64 bits."""
    rows = [(1, [1e16, 0.0]), (2, [-1e16, 1.0]), (3, [0.5, 2.0])]
    docs = table(spark, rows)
    fitted = wh.fit_whitening(docs)
    x, sums, *_ = plain([v for _, v in rows])
    assert list(fitted.sums.totals) == sums
    want = [sum((3 * c - t) ** 2 for c, t in zip(r, sums, strict=True)) for r in x]
    found = {r.vec_id: r.deviation for r in wh.whiten(docs, fitted).collect()}
    assert found == {i: w if w < 2**63 else None for (i, _), w in zip(rows, want, strict=True)} and None in found.values()
    near = wh.Sums(1 << 40, ((1 << 40) * 5 + 3, -7))
    x = np.array([[5, 0], [6, -1], [2005, 9]])
    want = [sum(((1 << 40) * int(c) - t) ** 2 for c, t in zip(r, near.totals, strict=True)) for r in x]
    assert near.deviations(x) == [w if w < 2**63 else None for w in want]


def test_tables_without_variance(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None), (2, [])]):
        docs = table(spark, rows)
        assert wh.whiten(docs, wh.fit_whitening(docs)).count() == 0


def test_triangular_solves_give_orthogonal_rows():
    made = np.random.default_rng(2)
    a = made.normal(size=(500, 130)) * np.logspace(0, -9, 130)
    factors = []
    for _ in range(4):
        q = wh.solve_rows(factors, a)
        factors.append(wh._upper_factor(q.T @ q, len(a), shifted=not factors))
    q = wh.solve_rows(factors, a)
    assert np.abs(q.T @ q - np.eye(130)).max() < 1e-12
    r = factors[3] @ factors[2] @ factors[1] @ factors[0]
    assert np.abs(q @ r - a).max() < 1e-12
