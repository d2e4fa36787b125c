"""Budgets against all sums."""

import numpy as np
import pytest

from lauter.llm.mixing import fit


def sums(sizes, counts):
    found = {0}
    for size, n in zip(sizes.tolist(), counts.tolist(), strict=True):
        found = {s + k * size for s in found for k in range(n + 1)}
    return found


@pytest.mark.parametrize("seed", range(200))
def test_no_sum_is_nearer(seed):
    rng = np.random.default_rng(seed)
    sizes = np.sort(rng.choice(np.arange(0 if seed % 5 else 1, 120), rng.integers(1, 6), replace=False))
    counts = rng.integers(1, 5, len(sizes))
    whole = int((sizes * counts).sum())
    budget = float(rng.uniform(0, whole * 1.1))
    taken = fit(sizes, counts, budget)
    assert (taken >= 0).all() and (taken <= counts).all()
    goal = int(round(min(budget, whole)))
    assert abs(int((taken * sizes).sum()) - goal) == min(abs(s - goal) for s in sums(sizes, counts))


def test_sums_the_share_would_miss():
    assert fit(np.array([7, 10]), np.array([3, 3]), 21.0).tolist() == [3, 0]
    assert fit(np.array([7, 100]), np.array([1, 1]), 57.0).tolist() == [0, 1]


def test_budgets_beyond_the_bound_are_met():
    rng = np.random.default_rng(1)
    sizes, counts = np.arange(1, 400), rng.integers(1, 2_000, 399)
    for budget in (70_000, 1_234_567, 40_000_001):
        assert int((fit(sizes, counts, budget) * sizes).sum()) == min(budget, int((sizes * counts).sum()))
