"""Properties that must hold for any input, and brute-force comparisons on small ones."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.functions import scalar
from ledgerlens.operators import explore, features, metrics, neighbours, ranking, sampling
from ledgerlens.registry.data import Data


@pytest.fixture(scope="module")
def data(spark, sf_dir):
    return Data(spark, sf_dir)


def test_amounts_do_not_depend_on_row_order_or_layout(spark, sf_dir):
    def table(shuffled):
        d = Data(spark, sf_dir)
        if shuffled:
            d.__dict__["raw_transactions"] = d.raw_transactions.repartition(5).sortWithinPartitions(F.rand(7))
            d.__dict__["fx_rates"] = d.fx_rates.repartition(3).orderBy(F.rand(3))
        return sorted(tuple(r) for r in d.features.select("id", "mean_amount", "first_amount", "source_freq").collect())

    assert table(False) == table(True)


def test_global_row_number_is_the_window_row_number(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("g"), F.pmod(F.hash("id"), F.lit(997)).alias("v"))
    got = ranking.global_row_number(df, ["g"], F.floor(F.col("v") / 10), ["v", "id"], "rn", "n")
    w = Window.partitionBy("g")
    want = df.withColumn("want", F.row_number().over(w.orderBy("v", "id"))).withColumn("size", F.count("*").over(w))
    joined = got.join(want, ["id", "g", "v"])
    assert joined.count() == 5000
    assert joined.where("rn <> want OR n <> size").count() == 0


def test_quartiles_against_numpy(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.lognormal(3, 3, 700), -rng.lognormal(1, 2, 200), np.zeros(300), [1e12, -1e12]])
    rows = [(i % 2, float(v)) for i, v in enumerate(values)]
    got = explore.boxplot_stats(spark.createDataFrame(rows, "g int, v double"), ["g"], "v").collect()
    for r in got:
        x = np.array([v for g, v in rows if g == r.g])
        q = np.quantile(x, [0.25, 0.5, 0.75])
        assert [r.q1, r.median, r.q3] == pytest.approx(list(q), rel=1e-12)
        low, high = q[0] - 1.5 * (q[2] - q[0]), q[2] + 1.5 * (q[2] - q[0])
        inside = x[(x >= low) & (x <= high)]
        assert (r.whisker_low, r.whisker_high) == (inside.min(), inside.max())
        assert (r.n, r.outliers) == (len(x), len(x) - len(inside))


def test_approximate_quartiles_are_close(spark, data):
    exact = explore.boxplot_stats(data.users, ["is_fraudster"], "birth_year").orderBy("is_fraudster").collect()
    quick = explore.boxplot_stats_approx(data.users.where("birth_year IS NOT NULL"), ["is_fraudster"], "birth_year")
    for e, q in zip(exact, quick.orderBy("is_fraudster").collect()):
        assert e.n == q.n and abs(e.median - q.median) <= 1


def test_auc_equals_the_library(spark):
    df = spark.range(3000).select(
        F.pmod(F.hash("id"), F.lit(2)).alias("label"), (F.pmod(F.hash(F.col("id") + 7), F.lit(501)) / 500).alias("score")
    )
    ours = metrics.roc_auc(df).first().auc
    theirs = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(
        df.withColumn("label", F.col("label").cast("double"))
    )
    assert 0 <= ours <= 1 and ours == pytest.approx(theirs, abs=1e-12)


def test_split_parts_cover_and_keep_shares(data):
    split = sampling.stratified_split(data.points, 0.2)
    assert split.count() == data.points.count() == split.select("id").distinct().count()
    for r in split.groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.col("part") == "test").alias("t")).collect():
        assert r.t == int(r.n * 0.2 + 0.5)


def test_balancing_makes_classes_equal(data):
    under = sampling.class_counts(sampling.under_sample(data.points))
    assert len(set(under.values())) == 1
    grown = sampling.smote(data.points, ["x1", "x2"])
    assert len(set(sampling.class_counts(grown).values())) == 1
    assert grown.select("id").distinct().count() == grown.count()


def test_smote_spreads_large_copy_numbers(spark, monkeypatch):
    monkeypatch.setattr(sampling, "_COPIES_PER_BLOCK", 7)
    rows = [(i, float(i), float(i % 5), 1 if i < 3 else 0) for i in range(103)]
    df = spark.createDataFrame(rows, "id long, x1 double, x2 double, label int")
    grown = sampling.smote(df, ["x1", "x2"])
    assert sampling.class_counts(grown) == {0: 100, 1: 100}
    made = grown.where("id LIKE '%#%'")
    assert made.select("id").distinct().count() == 97
    assert made.where("x1 < 0 OR x1 > 2").count() == 0


def _d2(a, b):
    total = 0.0  # sum() would compensate rounding and split equal distances
    for x, y in zip(a, b):
        total += (x - y) * (x - y)
    return total


def _brute(q, p, k, exclude):
    out = {}
    for qid, *qx in q:
        ds = sorted((_d2(qx, px), pid) for pid, _, *px in p if not (exclude and pid == qid))
        out[qid] = [i for _, i in ds[:k]]
    return out


@pytest.mark.parametrize("cell_rows", [10_000, 40, 7])
@pytest.mark.parametrize("exclude", [True, False])
def test_neighbours_against_brute_force(spark, cell_rows, exclude):
    """Clusters, many copies of one point (a third of all rows) and equal distances."""
    rng = np.random.default_rng(3)
    points = [(i, int(i % 2), *map(float, rng.normal(rng.integers(0, 4) * 5, 1, 3).round(1))) for i in range(300)]
    points += [(300 + i, 1, 5.0, 5.0, 5.0) for i in range(150)]
    df = spark.createDataFrame(points, "id long, label int, x double, y double, z double")
    got = neighbours.nearest_neighbours(df.drop("label"), df, ["x", "y", "z"], 4, exclude, cell_rows)
    found = {r.id: [n.id for n in r.neighbours] for r in got.collect()}
    want = _brute([(p[0], *p[2:]) for p in points], points, 4, exclude)
    assert found == want


@pytest.mark.parametrize("cell_rows", [1000, 15])
def test_neighbours_of_far_away_queries(spark, cell_rows):
    """Cells without queries and queries far from every cell."""
    points = [(i, i % 2, float(i * i % 97)) for i in range(200)]
    asked = [(1000 + i, 900.0 + i) for i in range(5)] + [(2000, -50.0), (2001, 10.5)]
    df = spark.createDataFrame(points, "id long, label int, x double")
    got = neighbours.nearest_neighbours(
        spark.createDataFrame(asked, "id long, x double"), df, ["x"], 3, False, cell_rows)
    assert {r.id: [n.id for n in r.neighbours] for r in got.collect()} == _brute(asked, points, 3, False)


@pytest.mark.parametrize("cell_rows", [10_000, 25])
def test_neighbours_of_groups_stay_in_their_group(spark, cell_rows):
    """One keyed search gives what a search of each group gives, also where groups hold equal points."""
    rng = np.random.default_rng(4)
    rows = [(f"g{i % 3}", i // 3, int(i % 2), *map(float, rng.normal(0, 2, 2).round(1))) for i in range(360)]
    rows += [(None, i, 0, 1.0, float(i)) for i in range(9)]
    df = spark.createDataFrame(rows, "part string, id long, label int, x double, y double")
    got = neighbours.nearest_neighbours(df.drop("label"), df, ["x", "y"], 3, True, cell_rows, ["part"]).collect()
    assert len(got) == len(rows)
    for part in ("g0", "g1", "g2", None):
        points = [r[1:] for r in rows if r[0] == part]
        want = _brute([(p[0], *p[2:]) for p in points], points, 3, True)
        assert {r.id: [n.id for n in r.neighbours] for r in got if r.part == part} == want


def test_few_points_are_touched_in_encoded_columns():
    """25 columns as after encoding: nine numbers, and rare and frequent dummies that are scaled."""
    rng = np.random.default_rng(5)
    n = 12_000
    numbers = [rng.integers(0, 900, n), rng.integers(0, 60, n), *(rng.random(n) < p for p in (.9, .3, .7, .4)),
               rng.exponential(1e6, n).round(), rng.random(n) < .8, rng.integers(1, 6, n)]
    shares = ([.4, .3, .2, .1], [.5, .3, .1, .07, .03], [.8, .1, .06, .03, .01], [.9, .1])
    for share in shares:
        value = rng.choice(len(share), n, p=share)
        numbers += [value == v for v in range(len(share))]
    x = np.array(numbers, dtype=float).T
    assert x.shape[1] == 25
    points = np.unique((x - x.mean(axis=0)) / x.std(axis=0), axis=0)
    leaves = neighbours.Leaves(points, np.argsort(-points.var(axis=0)))
    asked = points[rng.permutation(len(points))[:500]]
    d2, rows, touched = leaves.search(asked, np.full(500, np.inf), 6)
    assert touched < 0.1 * len(asked) * len(points)
    whole = np.zeros((500, len(points)))
    for j in range(25):
        whole += (asked[:, j, None] - points[None, :, j]) ** 2
    order = np.argsort(whole, axis=1, kind="stable")[:, :6]
    assert np.array_equal(rows, order) and np.array_equal(d2, np.take_along_axis(whole, order, axis=1))
    # A limit hides what is beyond it, and nothing else.
    limit = d2[:, 2].copy()
    near, at, fewer = leaves.search(asked, limit, 6)
    assert fewer < touched and np.array_equal(np.where(d2 <= limit[:, None], rows, len(points)), at)


def test_cells_of_two_levels_cover_all_points():
    rng = np.random.default_rng(6)
    sample = rng.normal(size=(400, 5))
    pivots = neighbours.Pivots(sample, 100)
    cells = pivots.cell_of(rng.normal(size=(3000, 5)))
    assert len(pivots.upper) == 10 and 50 < pivots.cells <= 100 and 0 <= cells.min() and cells.max() < pivots.cells
    assert len(np.unique(cells)) > 0.8 * pivots.cells and len(pivots.upper_of_cells()) == pivots.cells


@pytest.mark.parametrize("kind", ["under", "smote", "combine"])
def test_balancing_of_groups_is_that_of_each_group(spark, kind):
    rows = [(i % 3, i, int(i % (4 + i % 3) == 0), float(i * 7 % 31), float(i * 13 % 17)) for i in range(180)]
    rows += [(9, 1000 + i, 1, 0.5, float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "fold int, id long, label int, x1 double, x2 double")
    whole = sampling.resample(df, kind, ["x1", "x2"], groups=["fold"]).select("fold", "id", "label", "x1", "x2")
    got = sorted(map(tuple, whole.collect()))
    alone = []
    for fold in (0, 1, 2, 9):
        part = sampling.resample(df.where(F.col("fold") == fold).drop("fold"), kind, ["x1", "x2"])
        alone += [(fold, *r) for r in part.select("id", "label", "x1", "x2").collect()]
    assert got == sorted(alone)


def test_neighbours_fewer_points_than_asked(spark):
    df = spark.createDataFrame([(1, 0, 0.0), (2, 1, 1.0)], "id long, label int, x double")
    got = neighbours.nearest_neighbours(df, df, ["x"], 5, True).collect()
    assert {r.id: [n.id for n in r.neighbours] for r in got} == {1: [2], 2: [1]}


def test_any_number_of_categories(spark):
    df = spark.range(5000).select("id", F.concat(F.lit("v"), "id").alias("kind"))
    assert len(features.categories(df, ["kind"])["kind"]) == 5000
    rows = features.one_hot_vector(df, ["kind"]).collect()
    assert len({int(r.kind.indices[0]) for r in rows}) == 5000 and all(r.kind.values[0] == 1 for r in rows)


def test_two_hundred_thousand_categories_stay_in_tables(spark):
    """Places are those of the sorted values; NULL and unknown values share the last place."""
    n = 200_000
    df = spark.range(n).select("id", F.concat(F.lit("v"), F.col("id") * 7919 % n).alias("kind"), F.lit("one").alias("same"))
    found = features.category_dictionary(df, ["kind", "same"])
    assert found.sizes == {"kind": n, "same": 1}
    table = {r.value: r.at for r in found.table.where("name = 'kind'").collect()}
    assert [table[v] for v in sorted(table)] == list(range(n))
    odd = spark.createDataFrame([("v5", "one"), ("none", "two"), (None, None)], "kind string, same string")
    rows = features.one_hot_vector(odd, ["kind", "same"], found).collect()
    assert sorted((int(r.kind.indices[0]), int(r.same.indices[0])) for r in rows) == sorted([(table["v5"], 0), (n, 1), (n, 1)])
    assert {r.kind.size for r in rows} == {n + 1}
    with pytest.raises(ValueError):
        features.categories(df, ["kind"])


def test_mean_keeps_small_and_large_values(spark):
    df = spark.createDataFrame([(1, 1e-8), (1, 3e-8), (2, 1e19), (2, 3e19), (3, None)], "k int, v double")
    got = dict(df.groupBy("k").agg(scalar.stable_avg("v")).collect())
    assert got == {1: pytest.approx(2e-8), 2: pytest.approx(2e19), 3: None}


def test_value_named_like_the_margin(spark):
    df = spark.createDataFrame([(1, "All"), (1, "x"), (0, "x")], "r int, c string")
    shares = {(r.row_value, r.col_value): r.pct for r in explore.crosstab_row_pct(df, "r", "c").collect()}
    assert shares["1", "All"] == shares["1", "x"] == 50 and shares["0", "x"] == 100
    wide = {r.row_value: (r["All"], r["x"], r["All_"]) for r in explore.crosstab_wide(df, "r", "c").collect()}
    assert wide == {"1": (1, 1, 2), "0": (0, 1, 1), "All": (1, 2, 3)}


def test_scaled_columns_have_mean_0_and_deviation_1(data):
    scaled = features.standard_scale(data.users.select("id", "birth_year", F.lit(3).alias("same")).dropna(), ["birth_year", "same"])
    row = scaled.agg(F.avg("birth_year"), F.stddev_pop("birth_year"), F.max(F.abs("same"))).first()
    assert tuple(row) == pytest.approx((0, 1, 0), abs=1e-9)
