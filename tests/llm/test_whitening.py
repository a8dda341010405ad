import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from venuerank.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def vectors(n, d, seed=0):
    draw = np.random.default_rng(seed)
    spread = draw.normal(size=(d, d)) * np.linspace(2, 0.2, d)
    return (draw.normal(size=(n, d)) @ spread / 4).astype(np.float32)


def brute(rows, components=4):
    """From the definitions, with numpy's own solver: {vec_id: [(component, n, deviation, whitened, explained)]}."""
    x = {i: tuple(math.floor(256 * float(c)) + 0 for c in v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    fit = sorted(set(x.values()))
    n, d = len(fit), len(fit[0])
    sums = [sum(v[j] for v in fit) for j in range(d)]
    mean = np.array([s / n for s in sums])
    centred = np.array(fit, float) - mean
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    out = {}
    for i, v in x.items():
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, sums))
        scores = (np.array(v) - mean) @ u[:, :components] / np.sqrt(e[:components])
        out[i] = [(c + 1, n, deviation, scores[c], e[c] / e.sum()) for c in range(min(components, d))]
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(3).alias(c) for c in ("x", "n", "component", "i", "d")]).repartition(3)


def test_equals_the_definition(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(300, 12))]
    rows += [(1000 + i, rows[5][1]) for i in range(200)]  # a hot group of copies counts once
    bad = [(2000, None), (2001, [None] + [1.0] * 11), (2002, [float("nan")] * 12), (2003, [float("inf")] + [0.0] * 11)]
    got = whitening.whitened(table(spark, rows + bad)).collect()
    want = brute(rows)
    assert len(got) == 4 * len(rows)
    signs = {}
    for r in got:
        component, n, deviation, score, explained = want[r.vec_id][r.component - 1]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(explained, rel=1e-10) and 0 <= r.identity_error < 1e-9
        if abs(score) > 1e-6:
            sign = 1 if (score > 0) == (r.whitened > 0) else -1
            assert signs.setdefault(component, sign) == sign
            assert r.whitened == pytest.approx(sign * score, rel=1e-7)


@pytest.mark.parametrize("d", [1, 2, 3, 5, 40, 130])
def test_components_of_random_matrices(d):
    held = vectors(2 * d + 3, d, d).astype(float)
    matrix = held.T @ held
    values, found = whitening.leading_components(matrix, min(4, d))
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:4], rtol=1e-13)
    assert np.abs(matrix @ found - found * values).max() < 1e-13 * values[0] * d
    assert np.abs(found.T @ found - np.eye(len(values))).max() < 1e-14


def test_close_and_equal_eigenvalues_stay_orthogonal():
    q = np.linalg.qr(np.random.default_rng(4).normal(size=(20, 20)))[0]
    for leading in ([5, 5, 5, 5], [5, 5 - 1e-12, 5 - 2e-12, 1], [3, 3, 2, 2], [1, 1e-3, 1e-6, 1e-9]):
        e = np.array(leading + [1e-10] * 16)
        matrix = (q * e) @ q.T
        values, found = whitening.leading_components((matrix + matrix.T) / 2, 4)
        assert np.allclose(values, sorted(leading, reverse=True), atol=1e-13 * max(leading))
        assert np.abs(found.T @ found - np.eye(4)).max() < 1e-12
        assert np.abs(matrix @ found - found * values).max() < 1e-12 * max(leading)


def test_matrices_already_diagonal_or_block_diagonal():
    assert np.allclose(whitening.leading_components(np.diag([1.0, 5.0, 3.0, 3.0, 0.0]), 4)[0], [5, 3, 3, 1])
    assert np.allclose(whitening.leading_components(np.zeros((3, 3)), 2)[0], 0)
    values, found = whitening.leading_components(np.kron(np.eye(3), [[2.0, 1.0], [1.0, 2.0]]), 4)
    assert np.allclose(values, [3, 3, 3, 1]) and np.abs(found.T @ found - np.eye(4)).max() < 1e-12


def test_sturm_counts():
    draw = np.random.default_rng(2)
    diagonal, off = draw.normal(size=9), draw.normal(size=8)
    e = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
    at = np.sort(draw.normal(size=30) * 3)
    assert whitening.count_below(diagonal.astype(np.longdouble), off.astype(np.longdouble), at.astype(np.longdouble)).tolist() == [int((e < a).sum()) for a in at]


def test_fewer_dimensions_or_no_variance(spark):
    flat = [(i, [float(i % 5), 1.0]) for i in range(20)]  # one dimension never varies
    got = whitening.whitened(table(spark, flat)).collect()
    assert {r.component for r in got} == {1} and len(got) == 20 and all(r.n == 5 for r in got)
    assert got[0].explained == pytest.approx(1)
    assert whitening.whitened(table(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).collect() == []
    assert whitening.whitened(table(spark, [(1, None), (2, [])])).collect() == []
    assert whitening.whitened(table(spark, [])).collect() == []


def test_mixed_dimensions_negative_zero_and_huge_entries(spark):
    rows = [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [-0.0, 3e38]), (4, [1.0, 2.0, 3.0]), (5, [0.0, 3e38]), (6, [0.001, -0.001])]
    got = whitening.whitened(table(spark, rows)).collect()
    assert {r.vec_id for r in got} == {1, 2, 3, 5, 6} and {r.n for r in got} == {4}
    assert {r.deviation for r in got if r.vec_id == 3} == {None}


def test_long_deviations_are_exact(spark):
    draw = random.Random(1)
    rows = [(i, [draw.uniform(-1e5, 1e5) for _ in range(3)]) for i in range(40)]
    rows = [(i, np.float32(v).tolist()) for i, v in rows]
    want = brute(rows)
    assert all(r.deviation == want[r.vec_id][0][2] for r in whitening.whitened(table(spark, rows)).collect())
