"""Budgets met by documents longer than the table of the knapsack."""

from __future__ import annotations

import random
from itertools import product

from kalendra.llm import mixing


def test_long_documents_are_reconsidered():
    assert mixing.plan([60_000, 50_000, 49_000], [1, 1, 1], 99_000) == [0, 1, 1]
    assert mixing.plan([6_000_000, 5_000_000, 4_900_000], [1, 1, 1], 9_900_000) == [0, 1, 1]


def test_long_documents_reach_the_best_sum():
    rng = random.Random(5)
    for _ in range(60):
        sizes = rng.sample(range(33_000, 100_000), rng.randrange(1, 6))
        counts = [rng.randrange(1, 4) for _ in sizes]
        budget = rng.randrange(0, sum(s * c for s, c in zip(sizes, counts)) + 1)
        taken = mixing.plan(sizes, counts, budget)
        assert all(0 <= k <= c for k, c in zip(taken, counts))
        sums = {sum(s * k for s, k in zip(sizes, ks)) for ks in product(*(range(c + 1) for c in counts))}
        assert sum(s * k for s, k in zip(sizes, taken)) == max(x for x in sums if x <= budget)
