"""The packing search finds sequences that need other than the longest pieces or a filling fewer times."""

import numpy as np
import pytest

from hedonic.llm import packing


@pytest.mark.parametrize(
    "lengths, capacity, want",
    [
        ([50, 49, 48, 47, 46, 30, 29, 28, 28, 27, 26, 26, 23, 23, 20], 100, 5),  # 50 + 30 + 20, not 50 + 49
        ([6, 6, 4, 4, 3, 3, 2, 2], 10, 3),
    ],
)
def test_search_finds_the_optimum(lengths, capacity, want):
    counts = np.bincount(lengths, minlength=capacity + 1)
    plan = packing.plan_packing(counts, capacity)
    assert plan.sequences == want
    used = [x for filling, n in plan.fillings for x in filling * n]
    assert sorted(used) == sorted(lengths) and all(sum(f) <= capacity for f, _ in plan.fillings)


def test_fillings_come_by_waste():
    counts = np.bincount([5, 5, 4, 4, 3, 3], minlength=13)
    taken = packing._Stock(counts)
    assert next(packing._fillings(taken, 5, 12, lambda: 12)) == (5, 4, 3)
    assert len([f for f in packing._fillings(taken, 5, 12, lambda: 12) if f]) > 1
