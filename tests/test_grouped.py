"""Fits of many cells at once equal fits of each cell, and those of plain numpy."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from ledgerlens.operators import metrics
from ledgerlens.plans import grouped, models, training
from ledgerlens.session import materialise, scratch_path

COLUMNS = ["f0", "f1", "f2"]


def table(seed=1, cells=(0, 1, 5), n=150):
    draw = np.random.default_rng(seed)
    rows = []
    for cell in cells:
        x = draw.normal(size=(n, 3)).round(3)
        y = (x @ [1.5, -1.0, 0.3] + draw.normal(size=n) + 0.2 * cell > 0.5).astype(int)
        rows += [(cell, f"{cell}-{i}", int(y[i]), *map(float, x[i])) for i in range(n)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return table() + [(7, f"7-{i}", 1, float(i), 0.0, 1.0) for i in range(20)]


@pytest.fixture(scope="module")
def cells(spark, rows):
    df = spark.createDataFrame(rows, "cell int, id string, label int, f0 double, f1 double, f2 double")
    return materialise(df.repartition(5), "cells")


def part(rows, cell):
    mine = [r for r in rows if r[0] == cell]
    return np.array([r[3:] for r in mine]), np.array([r[2] for r in mine], dtype=float)


def test_discriminants_equal_those_of_each_cell(spark, cells, rows):
    found = grouped.fit_discriminants(cells, COLUMNS)
    for cell in (0, 1, 5):
        x, y = part(rows, cell)
        m0, m1 = x[y == 0].mean(axis=0), x[y == 1].mean(axis=0)
        rest = np.concatenate([x[y == 0] - m0, x[y == 1] - m1])
        weights = np.linalg.solve(rest.T @ rest / (len(x) - 2), m1 - m0)
        shift = -weights @ (m0 + m1) / 2 + np.log((y == 1).sum() / (y == 0).sum())
        assert np.allclose(found[cell], [*weights, shift])
        scored = models.predict(models.fit_lda(cells.where(F.col("cell") == cell), COLUMNS), cells.where(F.col("cell") == cell))
        want = {r.id: r.score for r in scored.collect()}
        got = grouped.linear_scores(cells.where(F.col("cell") == cell), COLUMNS, found).collect()
        assert all(r.score == pytest.approx(want[r.id]) for r in got)
    only = grouped.linear_scores(cells.where("cell = 7"), COLUMNS, found).select("score").distinct().collect()
    assert [r.score for r in only] == [1.0]


def test_logistic_equals_the_library_with_the_same_penalty(cells, rows):
    found = grouped.fit_logistic(cells, COLUMNS)
    for cell in (0, 5):
        mine = models.assembler(COLUMNS).transform(cells.where(F.col("cell") == cell))
        n = mine.count()
        fit = LogisticRegression(regParam=1 / n, standardization=False, maxIter=500, tol=1e-12).fit(mine)
        assert np.allclose(found[cell], [*fit.coefficients.toArray(), fit.intercept], atol=1e-4)
    assert np.isinf(found[7][-1])


def test_margins_are_at_the_minimum(cells, rows):
    mapping = grouped.CosineMap.draw(3, 16)
    found = grouped.fit_margins(cells, COLUMNS, mapping)
    for cell in (0, 1, 5):
        x, y = part(rows, cell)
        z, sign, w = np.column_stack([mapping(x), np.ones(len(x))]), 2 * y - 1, found[cell]
        slope = np.append(w[:-1], 0) - 2 * (sign * np.maximum(1 - sign * (z @ w), 0)) @ z
        assert np.abs(slope).max() < 1e-4
    x, _ = part(rows, 0)
    wide = grouped.CosineMap.draw(3, 20_000)
    d2 = ((x[:20, None] - x[None, :20]) ** 2).sum(axis=2)
    assert np.abs(wide(x[:20]) @ wide(x[:20]).T - np.exp(-d2 / 3)).max() < 0.05


def test_kernel_separates_rings_that_a_line_cannot(spark):
    draw = np.random.default_rng(2)
    rows = []
    for i in range(600):
        y, angle = i % 2, draw.uniform(0, 2 * np.pi)
        r = (1.0 if y else 2.5) + draw.normal(0, 0.2)
        rows.append((str(i), y, float(r * np.cos(angle)), float(r * np.sin(angle))))
    df = spark.createDataFrame(rows, "id string, label int, f0 double, f1 double")
    train, test = df.where("cast(id as int) % 3 > 0"), df.where("cast(id as int) % 3 = 0")
    auc = {n: metrics.roc_auc(models.predict(models.fit_model(n, train, ["f0", "f1"]), test)).first().auc
           for n in ("SVM", "LogitReg")}
    assert auc["SVM"] > 0.98 and auc["LogitReg"] < 0.7


def brute_boosting(x, y, edges, s):
    """Trees by the definition: every cut of every column of every node is tried on the rows themselves."""
    bins = grouped.binned(x, edges)
    total, gains = np.zeros(len(x)), []

    def grow(rows, depth, g, h, out):
        leaf = -g[rows].sum() / (h[rows].sum() + s.ridge)
        if depth == 0:
            out[rows] = leaf
            return
        best = (1e-6, None, None)
        for j in range(x.shape[1]):
            for cut in range(max(len(e) for e in edges)):
                left, right = rows[bins[rows, j] <= cut], rows[bins[rows, j] > cut]
                if h[left].sum() < s.least_curve or h[right].sum() < s.least_curve:
                    continue
                gain = sum(g[r].sum() ** 2 / (h[r].sum() + s.ridge) for r in (left, right))
                gain = round(gain - g[rows].sum() ** 2 / (h[rows].sum() + s.ridge), 9)
                if gain > best[0]:
                    best = (gain, left, right)
        if best[1] is None:
            out[rows] = leaf
            return
        for r in best[1:]:
            grow(r, depth - 1, g, h, out)

    for _ in range(s.trees):
        p = 1 / (1 + np.exp(-total))
        out = np.zeros(len(x))
        grow(np.arange(len(x)), s.depth, p - y, p * (1 - p), out)
        total += s.rate * out
    return 1 / (1 + np.exp(-total))


def test_boosting_equals_brute_force(cells, rows):
    s = grouped.Boosting(trees=4, depth=2, bins=8)
    edges, trees = grouped.fit_boosted(cells, COLUMNS, s)
    scored = grouped.boosted_scores(cells, COLUMNS, edges, trees, s).collect()
    for cell in (0, 1, 5, 7):
        x, y = part(rows, cell)
        want = brute_boosting(x, y, edges, s)
        got = {r.id: r.score for r in scored if r.cell == cell}
        assert np.allclose([got[r[1]] for r in rows if r[0] == cell], want)


@pytest.mark.parametrize("name", models.MODEL_NAMES)
def test_every_model_survives_storage(spark, cells, name):
    mine = cells.where("cell = 0").drop("cell").withColumn("score_of", F.lit(1))
    model = models.fit_model(name, mine, COLUMNS)
    folder = scratch_path(spark, "stored")
    model.write().save(folder)
    before, after = (sorted((r.id, r.score, r.prediction) for r in models.predict(m, mine).collect())
                     for m in (model, PipelineModel.load(folder)))
    assert before == after and len(before) == 150
    assert {p for _, _, p in before} == {0.0, 1.0}


def test_jobs_do_not_grow_with_the_folds(spark, cells):
    """Models that are fitted together take as many jobs for nine cells as for three."""
    def jobs(splits):
        group = f"jobs-{splits}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            train, test = training.fold_cells(cells.where("cell = 1"), COLUMNS, ("smote",), splits)
            for name in ("KNN", "LDA", "XGB"):
                training._scored_together(name, train, test, COLUMNS).collect()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    few, many = jobs(3), jobs(9)
    assert 0 < many <= few * 1.1 + 3


def test_cells_are_the_folds_balanced_each_by_itself(spark, cells):
    data = cells.where("cell = 1").drop("cell")
    kinds = ("under", "smote", "combine", None)
    train, test = training.fold_cells(data, COLUMNS, kinds, 3)
    folded = data.withColumn("fold", training.fold_of("id", 3))
    for i, kind in enumerate(kinds):
        for fold in range(3):
            got = train.where(F.col("cell") == 3 * i + fold).drop("cell").collect()
            want = training.resample(folded.where(F.col("fold") != fold).drop("fold"), kind, COLUMNS).collect()
            assert sorted(map(tuple, got)) == sorted(map(tuple, want))
            rest = test.where(F.col("cell") == 3 * i + fold).select("id").collect()
            assert {r.id for r in rest} == {r.id for r in folded.where(F.col("fold") == fold).collect()}
