"""Cells of the neighbour search: boxes that do not overlap, so that a query opens few of them."""

import numpy as np

from ledgerlens.operators import neighbours
from ledgerlens.plans import training


def encoded(n, seed=5):
    """25 columns as after encoding: numbers and scaled dummies."""
    draw = np.random.default_rng(seed)
    numbers = [draw.integers(0, 9000, n), draw.integers(0, 60, n), draw.exponential(1e6, n).round(), draw.integers(1, 6, n)]
    numbers += [draw.random(n) < p for p in (.9, .3, .7, .4, .8)]
    for share in ([.4, .3, .2, .1], [.5, .3, .1, .07, .03], [.8, .1, .06, .03, .01], [.9, .1]):
        value = draw.choice(len(share), n, p=share)
        numbers += [value == v for v in range(len(share))]
    x = np.array(numbers, dtype=float).T
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    return np.unique(x, axis=0)


def test_a_query_opens_few_cells():
    x = encoded(40_000)
    draw = np.random.default_rng(1)
    cells = 40
    pivots = neighbours.Pivots(x[draw.permutation(len(x))[:neighbours.CELL_SAMPLE * cells]], cells)
    of = pivots.cell_of(x)
    assert 30 <= pivots.cells <= cells and np.bincount(of, minlength=cells).max() < 0.25 * len(x)
    held = [x[of == c] for c in np.unique(of)]
    lo, hi = np.array([p.min(axis=0) for p in held]), np.array([p.max(axis=0) for p in held])
    asked = x[draw.permutation(len(x))[:300]]
    fourth = np.array([np.partition(((x - q) ** 2).sum(axis=1), 4)[4] for q in asked])
    opened = (neighbours.box_gaps(asked, lo, hi) <= fourth[:, None] * neighbours.MARGIN).sum(axis=1)
    assert opened.min() >= 1 and opened.mean() < 6


def test_cells_of_an_upper_part_follow_one_another():
    draw = np.random.default_rng(2)
    for sample in (draw.normal(size=(500, 3)), np.zeros((1, 3)), np.zeros((0, 3)), np.repeat([[0.0, 1.0]], 9, axis=0)):
        for cells in (1, 2, 30):
            pivots = neighbours.Pivots(sample, cells)
            upper = pivots.upper_of_cells()
            assert 1 <= pivots.cells <= cells and len(upper) == pivots.cells
            assert (np.diff(upper) >= 0).all() and set(upper) == set(range(len(pivots.upper)))
            of = pivots.cell_of(sample)
            assert len(of) == len(sample) and (not len(of) or 0 <= of.min() <= of.max() < pivots.cells)


def test_a_fit_of_one_cell_reads_that_cell_alone(spark):
    rows = spark.range(300).selectExpr(
        "CAST(id AS STRING) AS id", "CAST(id % 7 = 0 AS INT) AS label", "CAST(id AS DOUBLE) AS f0", "CAST(id % 13 AS DOUBLE) AS f1")
    train, test = training.fold_cells(rows, ["f0", "f1"], (None, "under"), 3)
    for cells in (train, test):
        assert {r.cell for r in cells.select("cell").distinct().collect()} == set(range(6))
        # Few rows of one cell are one task, whatever the number of shuffle partitions.
        assert cells.where("cell = 4").rdd.getNumPartitions() == 1
    assert test.where("cell < 3").count() == 300 and train.where("cell < 3").count() == 600
