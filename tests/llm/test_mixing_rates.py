"""Rates against a direct least-squares solution, and labels that contradict each other."""

import numpy as np
from pyspark.sql import functions as F

from quern.llm import mixing
from quern.llm.textclass import bounded_sample


def nonnegative_least_squares(a, b, steps=200_000):
    """min |a r - b|^2 over 0 <= r, by plain projected gradient from ones."""
    r, step = np.ones(a.shape[1]), 1 / np.linalg.norm(a, 2) ** 2
    for _ in range(steps):
        r = np.maximum(0, r - step * (a.T @ (a @ r - b)))
    return r


def test_rates_against_direct_solution(spark):
    """Targets inside and outside what nonnegative rates can reach: the totals are those of the direct solution."""
    r = np.random.default_rng(3)
    for corner in (False, True):
        p = r.dirichlet([1.0, 1.0, 1.0], 40) if not corner else r.dirichlet([20.0, 20.0, 20.0], 40)
        n = r.integers(5, 60, 40)
        rows = spark.createDataFrame([(int(k), [float(x) for x in q]) for k, q in zip(n, p)], "n_tokens long, p array<double>")
        weights = {"a": 0.2, "b": 0.3, "c": 0.5} if not corner else {"a": 0.05, "b": 0.05, "c": 0.9}
        steps, totals, targets = mixing.fit_rates(rows, weights, ["a", "b", "c"])
        direct = nonnegative_least_squares((p * n[:, None]).T, targets)
        best, own = (p * n[:, None]).T @ direct, np.abs(totals - targets).sum()
        assert own <= np.abs(best - targets).sum() + 0.02 * targets.sum()
        if not corner:
            assert np.allclose(totals, targets, rtol=2e-3)


def test_contradicting_labels_are_left_out(spark):
    labels = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "a"), (3, "b"), (None, "a"), (4, None)], "k long, d string")
    assert sorted(bounded_sample(labels, "k", F.col("d"), ["a", "b"], 5)) == [(2, "a"), (3, "b")]
