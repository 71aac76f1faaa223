"""Models on a learnable table: better than a constant score, stable through storage."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ledgerlens.operators import metrics
from ledgerlens.plans import models, training
from ledgerlens.registry.data import Data
from ledgerlens.session import materialise, scratch_path

COLUMNS = ["f0", "f1", "f2"]


@pytest.fixture(scope="module")
def rows(spark):
    def noise(k):
        return F.pmod(F.hash(F.col("id") + k), F.lit(1000)) / 1000

    base = spark.range(600).select(
        F.col("id").cast("string").alias("id"), noise(1).alias("f0"), noise(2).alias("f1"), noise(3).alias("f2"))
    label = ((F.col("f0") + 0.5 * F.col("f1") + 0.2 * F.pmod(F.hash("id"), F.lit(5)) / 5) > 0.95).cast("int")
    return materialise(base.withColumn("label", label), "model-rows")


@pytest.mark.parametrize("name", models.MODEL_NAMES)
def test_model_beats_a_constant_score(rows, name):
    train, test = rows.where("cast(id as int) % 4 > 0"), rows.where("cast(id as int) % 4 = 0")
    scored = models.predict(models.fit_model(name, train, COLUMNS), test)
    assert scored.count() == test.count()
    assert {"score", "prediction"} <= set(scored.columns) and "features" not in scored.columns
    auc = metrics.roc_auc(scored).first().auc
    assert 0.8 < auc <= 1 and auc == pytest.approx(training.auc_of(scored))


def test_unknown_model_is_refused(rows):
    with pytest.raises(ValueError):
        models.fit_model("nope", rows, COLUMNS)


@pytest.mark.parametrize("resample_first", [False, True])
def test_cross_validation_rows(rows, resample_first):
    scores = training.cv_auc_by_model(
        rows, COLUMNS, "under", n_splits=3, models=["LogitReg", "LDA"], resample_first=resample_first)
    got = {(r.model, r.fold): r.auc for r in scores.collect()}
    assert set(got) == {(m, f) for m in ("LogitReg", "LDA") for f in range(3)}
    assert all(0.5 < v <= 1 for v in got.values())
    assert training.auc_summary(scores).count() == 2


def test_grid_search_returns_the_best(rows):
    best, params, table = training.grid_search(rows, COLUMNS, "RF", {"numTrees": [2, 5]}, n_splits=3)
    assert isinstance(best, PipelineModel) and params["numTrees"] in (2, 5) and table.count() == 2


def test_encoding_and_model_survive_storage(spark, sf_dir):
    d = Data(spark, sf_dir)
    table = materialise(d.features, "features")
    trained = training.train_model(table, training.ModelSettings(sampling="smote"))
    folder = scratch_path(spark, "model")
    start = d.users.agg(F.min("created_date").alias("min_date"))
    training.save_pipeline(trained, start, folder)
    loaded, kept = training.load_pipeline(spark, folder)
    assert kept.first() == start.first()
    before = models.predict(trained.pipeline, table).select("id", "score").orderBy("id").collect()
    after = models.predict(loaded, table).select("id", "score").orderBy("id").collect()
    assert before == after and len(before) == 150
    counts = {(r.stage, r.label): r.n for r in trained.balance.collect()}
    assert counts["after", 0] == counts["after", 1] == counts["before", 0]


def test_encoding_is_fitted_on_the_train_part_only(spark, sf_dir):
    table = materialise(training.labelled(Data(spark, sf_dir).features), "features")
    encoding = training.fit_encoding(table)
    encoded = training.encode(encoding, table)
    stats = encoded.agg(*[F.avg(c) for c in encoding.columns], *[F.stddev_pop(c) for c in encoding.columns]).first()
    half = len(encoding.columns)
    assert all(abs(v) < 1e-9 for v in stats[:half])
    assert all(abs(v - 1) < 1e-9 or v == 0 for v in stats[half:])
    odd = table.limit(1).withColumn("kyc", F.lit("NEVER SEEN"))
    kyc = [i for i, n in enumerate(encoding.names) if n.startswith("kyc_")]
    plain = training.encode(encoding, odd).first()
    filled = training.encode(training.fit_encoding(table, missing_dummy=-1.0), odd).first()
    assert all(filled[f"f{i}"] < plain[f"f{i}"] for i in kyc)


def test_training_on_sparse_categories_of_any_number(spark, sf_dir):
    """More values than columns are allowed: dictionary, sparse vectors, storage and scoring."""
    table = Data(spark, sf_dir).features.withColumn("kyc", F.concat("kyc", F.col("id") * 131 % 50_000))
    many = materialise(table.unionByName(table.withColumn("id", F.col("id") + 1_000_000).withColumn("kyc", F.lit("same"))), "many")
    settings = training.ModelSettings(sampling="under", model="RF", params={"numTrees": 3}, sparse=True)
    trained = training.train_model(many, settings)
    folder = scratch_path(spark, "sparse")
    trained.pipeline.write().overwrite().save(folder)
    before, after = (sorted((r.id, r.score) for r in models.predict(p, many).select("id", "score").collect())
                     for p in (trained.pipeline, PipelineModel.load(folder)))
    assert before == after and len(before) == many.count()
    assert all(0 <= score <= 1 for _, score in before)
    with pytest.raises(ValueError):
        training.train_model(many, training.ModelSettings(sampling="smote", sparse=True))


def test_columns_whose_category_no_scored_row_has_are_filled(spark, sf_dir):
    table = materialise(training.labelled(Data(spark, sf_dir).features), "features")
    plain, filled = training.fit_encoding(table), training.fit_encoding(table, absent_dummy=-1.0)
    whole = [sorted(map(tuple, training.encode(e, table).collect())) for e in (plain, filled)]
    assert whole[0] == whole[1]
    one = table.limit(1)
    values = one.first()
    a, b = (training.encode(e, one).first() for e in (plain, filled))
    numbers = {n: f"f{i}" for i, n in enumerate(plain.names)}
    for name, column in numbers.items():
        source = next((c for c in ("terms_version", "type_freq", "state_freq", "kyc") if name.startswith(f"{c}_")), None)
        if source and name != f"{source}_{values[source]}":
            assert b[column] < a[column]
        else:
            assert b[column] == a[column]
    trained = training.train_model(table.drop("label"), training.ModelSettings(sampling="under", model="LDA", params={}, absent_dummy=-1.0))
    folder = scratch_path(spark, "absent")
    trained.pipeline.write().overwrite().save(folder)
    scored = models.predict(PipelineModel.load(folder), table)
    assert not [c for c in scored.columns if c.startswith("_present")] and scored.count() == table.count()
