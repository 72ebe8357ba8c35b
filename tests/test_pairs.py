"""Screening and coarsening of feature pairs."""

import random

import numpy as np
import pytest

from docket import constants as C
from docket.operators import additive
from docket.operators.binning import Bins


def plain_gain(g, h, reg=0.0):
    best = 0.0
    for a in range(1, g.shape[0]):
        for b in range(1, g.shape[1]):
            parts = [(g[i, j].sum(), h[i, j].sum()) for i in (slice(0, a), slice(a, None)) for j in (slice(0, b), slice(b, None))]
            best = max(best, sum(x * x / (y + reg) for x, y in parts if y > 1e-12))
    return best


@pytest.mark.parametrize("shape", [(2, 2), (5, 3), (17, 17), (1, 4), (4, 1)])
def test_running_sums_give_the_gain_of_every_cut(shape):
    rng = np.random.default_rng(sum(shape))
    g, h = rng.normal(size=shape), rng.integers(0, 3, size=shape).astype(float)
    g[h == 0] = 0
    assert additive.quadrant_gain(g, h, 0.0) == pytest.approx(plain_gain(g, h))
    assert additive.quadrant_gain(g, h, 0.7) == pytest.approx(plain_gain(g, h, 0.7))


def test_groups_keep_the_order_and_balance_weights():
    assert additive.coarse_groups(np.arange(4), np.ones(4), 8) == (0, 1, 2, 3, 4)
    groups = additive.coarse_groups(np.array([3, 1, 0, 2]), np.array([1.0, 1, 1, 1]), 2)
    assert groups == (0, 2, 1, 2, 1)
    # A hot value does not empty the other bins' numbers.
    hot = additive.coarse_groups(np.arange(100), np.r_[1000.0, np.ones(99)], 5)
    assert hot[0] == 0 and hot[1] == 1 and sorted(set(hot)) == list(range(max(hot) + 1)) and max(hot) <= 5


def wide_pair_cells(spark, values, rows):
    """Two nominal features whose parities decide together, and two of noise."""
    draw = random.Random(7)
    table = []
    for i in range(rows):
        a, b, c, d = (draw.randrange(values) + 1 for _ in range(4))
        # Each parity has a main effect, by which values are put in order; whether both agree decides more.
        chance = (0.7 if a % 2 == b % 2 else 0.3) + 0.2 * (a % 2 - 0.5) + 0.2 * (b % 2 - 0.5)
        table.append((i, int(draw.random() < chance), a, b, c, d))
    codes = spark.createDataFrame(table, f"{C.KEY} long, label int, b0 int, b1 int, b2 int, b3 int")
    bins = Bins({n: [f"{n}{i}" for i in range(values)] for n in "abcd"}, {})
    return codes, bins


def boosted(cells, bins, rounds, **params):
    boosting = additive.Boosting(cells, bins, {**additive.DEFAULTS, "outer_bags": 1, **params}, "round")
    boosting.run(boosting.add([additive.Term((i,), (bins.size(n),)) for i, n in enumerate(bins.names)]), rounds)
    return boosting


def test_values_are_merged_in_the_order_of_their_scores(spark):
    """Neighbouring values have opposite effects, so only merging by score keeps the pair that decides."""
    codes, bins = wide_pair_cells(spark, 60, 12_000)
    cells = additive.compact(codes, bins, C.KEY, 1).persist()
    boosting = boosted(cells, bins, 2, max_leaves=60)
    pairs = boosting.best_pairs(6, 8)
    assert pairs[0].features == (0, 1)
    odd = [np.mean([pairs[0].groups[0][v] for v in range(1, 61) if v % 2 == k]) for k in (0, 1)]
    assert odd[1] - odd[0] > 3
    before = boosting.final_loss()
    boosting.run(boosting.add(pairs[:1]), 3)
    assert boosting.final_loss() < before - 0.005
    cells.unpersist()


def test_wide_nominals_are_coarse_in_pairs(spark):
    """Ten pairs of nominal features of 1,000 values: what a round collects is bounded by the coarse bins."""
    codes, bins = wide_pair_cells(spark, 1000, 10_000)
    cells = additive.compact(codes, bins, C.KEY, 1).persist()
    boosting = boosted(cells, bins, 1)
    pairs = boosting.best_pairs(10, 16)
    assert len(pairs) == 6 and all(t.size <= 17 * 17 for t in pairs)
    collected = additive.gradients(cells, boosting.terms, boosting.scores, boosting.intercept, pairs).count()
    assert collected <= len(pairs) * 17 * 17
    cells.unpersist()


def test_batches_of_pairs_screen_alike(spark, monkeypatch):
    codes, bins = wide_pair_cells(spark, 30, 3000)
    cells = additive.compact(codes, bins, C.KEY, 2).persist()
    boosting = boosted(cells, bins, 2, outer_bags=2)
    whole = boosting.best_pairs(6, 8)
    monkeypatch.setattr(additive, "PAIRS_PER_JOB", 2)
    assert boosting.best_pairs(6, 8) == whole and len(whole) == 6
    assert boosting.best_pairs(0, 8) == []
    cells.unpersist()
