"""Sums and solutions of a half step, against plain ones."""

import numpy as np
import pytest

from venuerank.operators import factors


@pytest.mark.parametrize("rank", [1, 4])
def test_runs_of_any_length_are_summed_whole(monkeypatch, rank):
    monkeypatch.setattr(factors, "CHUNK", 16)
    draw = np.random.default_rng(rank)
    counts = np.array([1, 3, 40, 2, 1, 8, 9, 17, 4])
    heads = np.cumsum(counts) - counts
    features, at, stars = draw.normal(size=(30, rank)), draw.integers(0, 30, counts.sum()), draw.integers(1, 6, counts.sum()).astype(float)
    found = factors._sums_of(features, at, stars, heads, counts, rank)
    upper = np.triu_indices(rank)
    for row, head, n in zip(found, heads, counts):
        x = features[at[head : head + n]]
        assert row == pytest.approx(np.concatenate([(x.T @ x)[upper], x.T @ stars[head : head + n]]))


def test_rows_that_stand_still_leave_the_sweeps(monkeypatch):
    """Easy rows are done at once, hard ones go on; each is solved as if it were alone."""
    monkeypatch.setattr(factors, "SOLVED", 7)
    draw = np.random.default_rng(5)
    upper, sums, counts = np.triu_indices(4), [], []
    for i in range(40):
        n = 1 + i % 9
        x = draw.uniform(0.9, 1.1, (n, 4)) if i % 2 else np.eye(4)[draw.integers(0, 4, n)]
        sums.append(np.concatenate([(x.T @ x)[upper], x.T @ draw.uniform(-1, 5, n)]))
        counts.append(n)
    sums, counts = np.array(sums), np.array(counts)
    found = factors.solve(sums, counts, 4, 0.1)
    alone = np.concatenate([factors.solve(sums[i : i + 1], counts[i : i + 1], 4, 0.1) for i in range(40)])
    assert found == pytest.approx(alone, abs=1e-9) and (found >= 0).all()
    for x, s, n in zip(found[::2], sums[::2], counts[::2]):
        assert x == pytest.approx(np.maximum(0, s[10:]) / (s[[0, 4, 7, 9]] + 0.1 * n))
    assert factors.solve(np.zeros((0, 14)), np.zeros(0), 4, 0.1).shape == (0, 4)
