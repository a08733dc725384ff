"""Whitening against numpy's eigenvalues, and its exact steps against plain ones."""

from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest

from chronolens.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<double>, n int, whitened string"


def run(spark, rows, **how):
    return wh.whitened(spark.createDataFrame([(i, x, 7, "p") for i, x in rows], SCHEMA).repartition(3), **how).collect()


def brute(rows, most):
    good = [(i, np.floor(64 * np.array(v)) + 1000000) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in good}))
    n, mean = len(fit), fit.mean(0)
    e, v = np.linalg.eigh((fit - mean).T @ (fit - mean) / n)
    e, v = e[::-1][:most], v[:, ::-1][:, :most]
    return good, n, fit, e, v, mean


def test_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900 + i, x[5].tolist()) for i in range(200)]
    rows += [(None, x[6].tolist()), (1, x[7].tolist()), (800, None), (801, []), (802, [None] * 12), (803, [float("nan")] * 12)]
    good, n, fit, e, v, mean = brute(rows, 5)
    out = run(spark, rows, most=5)
    assert len(out) == 5 * len(good) and {r.n for r in out} == {n}
    assert len({r.identity_error for r in out}) == 1 and out[0].identity_error < 1e-9
    trace = np.trace((fit - mean).T @ (fit - mean) / n)
    sums = [int(s) for s in fit.sum(0)]
    want = {(i, x.tobytes()): (sum((n * int(c) - s) ** 2 for c, s in zip(x, sums)), (x - mean) @ v / np.sqrt(e)) for i, x in good}
    signs = {}
    for r in out:
        assert abs(r.explained - e[r.component - 1] / trace) < 1e-9
        options = [(d, w[r.component - 1]) for (i, _), (d, w) in want.items() if i == r.vec_id]
        match = [w for d, w in options if Decimal(d) == r.deviation and abs(abs(w) - abs(r.whitened)) < 1e-6]
        assert match
        if abs(r.whitened) > 1e-3:
            signs.setdefault(r.component, set()).add(np.sign(match[0]) == np.sign(r.whitened))
    assert all(len(s) == 1 for s in signs.values())


def test_equal_eigenvalues_share_a_space(spark):
    rows = [(i, (2.0 * s * np.eye(4)[d]).tolist()) for i, (d, s) in enumerate((d, s) for d in range(3) for s in (1, -1))]
    out = run(spark, rows, most=16)
    assert {r.component for r in out} == {1, 2, 3} and out[0].identity_error < 1e-9  # the fourth dimension is constant
    assert all(abs(r.explained - 1 / 3) < 1e-12 for r in out)


def test_constant_single_and_no_rows(spark):
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == run(spark, [(1, [1.0, 2.0])]) == run(spark, []) == run(spark, [(3, None)]) == []
    with pytest.raises(Exception, match="several lengths"):
        run(spark, [(1, [1.0, 2.0]), (2, [1.0])])


def test_large_entries_stay_exact(spark):
    rows = [(i, [1e9 * i, -3e8 * i * i, 7.0]) for i in range(9)]
    out = run(spark, rows)
    xs = [[int(np.floor(64 * c)) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*xs)]
    assert out[0].identity_error < 1e-9 and {r.component for r in out} == {1, 2}
    assert {(r.vec_id, int(r.deviation)) for r in out} == {(i, sum((9 * c - s) ** 2 for c, s in zip(x, sums))) for (i, _), x in zip(rows, xs)}


def test_polynomial_and_roots(spark):
    x = np.random.default_rng(3).integers(-50, 50, (9, 5))
    a = (x.T @ x).astype(object)
    e = wh.symmetric_functions(spark, a)
    # Newton's identities on the traces of powers
    power, p = [], a
    for _ in range(5):
        power.append(sum(p[i, i] for i in range(5)))
        p = p @ a
    want = [1]
    for k in range(1, 6):
        want.append(sum((-1) ** (i - 1) * want[k - i] * power[i - 1] for i in range(1, k + 1)) // k)
    assert e == want
    roots = wh.largest_roots(e, 5)
    assert np.allclose([float(r) for r, _ in roots], np.linalg.eigvalsh(a.astype(float))[::-1], rtol=1e-9)
    # (z - 7)**2 (z - 3) z: a double root, and one at zero that is left out
    assert [(round(float(r), 9), n) for r, n in wh.largest_roots([1, 17, 91, 147, 0], 9)] == [(7, 2), (3, 1)]
    close = [Fraction(10 ** 30 + 1), Fraction(10 ** 30)]  # told apart although doubles are not
    poly = [1, int(sum(close)), int(close[0] * close[1])]
    assert [n for _, n in wh.largest_roots(poly, 2)] == [1, 1]
    assert wh.polynomial_modulo(np.array([[0, 0, 2], [0, 3, 0], [2, 0, 0]], object), 101).tolist() == [12, 101 - 4, 101 - 3, 1]
