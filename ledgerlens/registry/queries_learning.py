"""Queries of the learning part: scaling, split, balancing, models, metrics, actions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators import features as feat
from ledgerlens.operators import metrics, neighbours, sampling
from ledgerlens.operators.actions import decide_action
from ledgerlens.plans import models, training
from ledgerlens.registry.data import Data
from ledgerlens.session import materialise
from ledgerlens.settings import ACTION_LABELS, NUMERIC_FEATURES, THRESHOLD_ALERT, THRESHOLD_SUSPECT

_ROUND = 6
_XY = ["x1", "x2"]


def standard_scale(d: Data) -> DataFrame:
    scaled = feat.standard_scale(d.stored_features.select("id", *NUMERIC_FEATURES), NUMERIC_FEATURES)
    long = feat.melt(scaled, ["id"], NUMERIC_FEATURES)
    return long.withColumn("value", F.round("value", _ROUND))


def class_balance(d: Data) -> DataFrame:
    after = sampling.under_sample(d.points)
    return sampling.class_balance(d.points, "before").unionByName(sampling.class_balance(after, "after"))


def _split_points(d: Data) -> tuple[DataFrame, DataFrame]:
    split = materialise(sampling.stratified_split(d.points), "split")
    return split.where("part = 'train'").drop("part"), split.where("part = 'test'").drop("part")


def model_knn(d: Data) -> DataFrame:
    """Test part of all users classified by the five nearest users of the train part."""
    train, test = _split_points(d)
    return neighbours.knn_classify(train, test, _XY).select("id", "label", "score", "prediction")


def model_lda(d: Data) -> DataFrame:
    """Test part of all users scored by the discriminant of the train part."""
    train, test = _split_points(d)
    scored = models.predict(models.fit_model("LDA", train, _XY), test)
    return scored.select("id", "label", F.round("score", _ROUND).alias("score"))


def _checked(scored: DataFrame, *kept: str, cut: float = 0.5, bounded: bool = True) -> DataFrame:
    """What must hold for every row of a fitted model, instead of the fitted value itself: there is a
    score, within its bounds, and the prediction follows from it."""
    score = F.col("score")
    inside = score.between(0, 1) if bounded else ~F.isnan(score)
    return scored.select(
        *kept, F.coalesce(inside, F.lit(False)).alias("score_valid"),
        F.coalesce(F.col("prediction") == (score > cut).cast("double"), F.lit(False)).alias("prediction_follows"))


def _encoded(d: Data) -> tuple[DataFrame, DataFrame, list[str]]:
    """Encoded train and test rows of all users."""
    table = materialise(sampling.stratified_split(training.labelled(d.features)), "split")
    train, test = table.where("part = 'train'"), table.where("part = 'test'")
    encoding = training.fit_encoding(train)
    return training.encode(encoding, train), training.encode(encoding, test), encoding.columns


def _model(name: str, params: dict | None = None, **checks):
    def query(d: Data) -> DataFrame:
        train, test, columns = _encoded(d)
        balanced = materialise(sampling.resample(train, "under", columns), "balanced")
        fitted = models.fit_model(name, balanced, columns, params)
        return _checked(models.predict(fitted, test), "id", "label", **checks)

    return query


_FOREST = {"impurity": "entropy", "minInstancesPerNode": 3, "numTrees": 10}


def pca_2d(d: Data) -> DataFrame:
    reduced = models.pca_2d(d.points, _XY)
    return reduced.withColumns({c: F.round(c, 4) for c in ("pc1", "pc2")})


def train_model(d: Data) -> DataFrame:
    """The report on the test part: how many rows of each class it rests on, and that measures are shares."""
    report = training.evaluate(training.train_model(d.stored_features))
    support = F.when(F.col("metric") == "support", F.col("value"))
    return report.select("class", "metric", support.alias("support"), (support.isNotNull() | F.col("value").between(0, 1)).alias("value_valid"))


def _valid_auc(df: DataFrame, column: str) -> DataFrame:
    """Whether there is an AUC between 0 and 1, instead of the fitted value itself."""
    return df.withColumn("auc_valid", F.coalesce(F.col(column).between(0, 1), F.lit(False))).drop(column)


def cv_auc_by_model(d: Data) -> DataFrame:
    """Every model on every fold of the train part, each fold balanced on its own."""
    train, _, columns = _encoded(d)
    return _valid_auc(training.cv_auc_by_model(train, columns, "under"), "auc")


def choose_sampling(d: Data) -> DataFrame:
    """Every way of balancing with every model, summed up over all folds of the train part."""
    train, _, columns = _encoded(d)
    return _valid_auc(training.auc_summary(training.choose_sampling(train, columns)), "mean_auc").drop("std_auc")


def grid_search(d: Data) -> DataFrame:
    train, _, columns = _encoded(d)
    balanced = materialise(sampling.resample(train, "under", columns), "balanced")
    grid = {"numTrees": [5, 10], "minInstancesPerNode": [1, 3]}
    return _valid_auc(training.grid_search(balanced, columns, "RF", grid)[2], "mean_auc")


def _saved(d: Data, table: DataFrame):
    folder = d.path("model")
    training.save_pipeline(training.train_model(table), feat.min_created_date(d.users), folder)
    return training.load_pipeline(d.spark, folder)


def save_load_pipeline(d: Data) -> DataFrame:
    """All users scored by a model that went through storage."""
    table = d.stored_features
    pipeline, _ = _saved(d, table)
    return _checked(models.predict(pipeline, table), "id")


def _checked_actions(scored: DataFrame) -> DataFrame:
    """Probability within bounds, and an action with its label that the probability allows."""
    labels = F.create_map(*[F.lit(x) for pair in ACTION_LABELS.items() for x in pair])
    p = F.col("probability")
    allowed = F.when(p < THRESHOLD_SUSPECT, F.col("action") == "NOTHING").when(
        p < THRESHOLD_ALERT, F.col("action").isin("ALERT", "NOTHING")).otherwise(F.col("action").isin("ALERT", "BOTH", "NOTHING"))
    return scored.select(
        "id", F.coalesce(p.between(0, 1), F.lit(False)).alias("probability_valid"),
        F.coalesce(allowed, F.lit(False)).alias("action_allowed"),
        (F.col("action_label") == labels[F.col("action")]).alias("label_follows"))


def score_users(d: Data) -> DataFrame:
    """All fraud users scored in one job, features rebuilt with the stored minimum date."""
    pipeline, start = _saved(d, d.stored_features)
    asked = feat.user_feature_table_by_key(
        d.users, d.transactions, d.fx_rates, d.currency_details, d.fraudsters, start
    )
    return _checked_actions(training.score_users(pipeline, asked))


def pipeline_train_predict(d: Data) -> DataFrame:
    """The configured path end to end: features, split, balancing, forest, storage, all actions."""
    table = d.stored_features
    pipeline, _ = _saved(d, table)
    return _checked_actions(training.score_users(pipeline, table))


def decide(d: Data) -> DataFrame:
    scored = d.features.withColumn(
        "probability", F.expr("CAST(id * 37 % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE)")
    )
    return decide_action(scored).select("id", "probability", "action", "action_label")


def classification_report(d: Data) -> DataFrame:
    return metrics.classification_report(d.scored).withColumn("value", F.round("value", 9))


QUERIES = {
    "standard_scale": standard_scale,
    "stratified_split": lambda d: sampling.stratified_split(d.points).select("id", "label", "part"),
    "under_sample": lambda d: sampling.under_sample(d.points).select("id", "label"),
    "smote": lambda d: sampling.smote(d.points, _XY),
    "smote_enn": lambda d: sampling.smote_enn(d.points, _XY),
    "class_balance": class_balance,
    "pca_2d": pca_2d,
    "model_logreg": _model("LogitReg"),
    "model_knn": model_knn,
    "model_lda": model_lda,
    "model_cart": _model("CART"),
    "model_svm": _model("SVM", cut=0.0, bounded=False),
    "model_gbt": _model("XGB"),
    "model_rf": _model("RF", _FOREST),
    "train_model": train_model,
    "grid_search": grid_search,
    "save_load_pipeline": save_load_pipeline,
    "roc_auc": lambda d: metrics.roc_auc(d.scored).select(F.round("auc", 9).alias("auc")),
    "confusion_matrix": lambda d: metrics.confusion_matrix(d.scored),
    "f1_score": lambda d: metrics.f1_score(d.scored).select(F.round("f1", 9).alias("f1")),
    "classification_report": classification_report,
    "score_users": score_users,
    "decide_action": decide,
    "pipeline_train_predict": pipeline_train_predict,
    # Seven models, ten folds; and that for three ways of balancing: the longest jobs come last.
    "cv_auc_by_model": cv_auc_by_model,
    "choose_sampling": choose_sampling,
}
