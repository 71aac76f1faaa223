"""Training, comparison, scoring: from the feature table to an action per user."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce
from itertools import product

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.scalar import flag
from ledgerlens.operators import metrics
from ledgerlens.operators.actions import decide_action
from ledgerlens.operators.features import categories, one_hot_expressions, scaler_stats
from ledgerlens.operators.neighbours import knn_classify
from ledgerlens.operators.sampling import edited, fold_of, resample, stratified_split
from ledgerlens.plans import forests, grouped
from ledgerlens.plans.models import MAX_DEPTH, MODEL_NAMES, fit_model, fit_sparse_model, predict
from ledgerlens.plans.transformers import PresentCategories, SparseFeatures
from ledgerlens.session import materialise, scratch_path
from ledgerlens.settings import CATEGORICAL_FEATURES, LABEL, NUMERIC_FEATURES, ModelSettings


# --- feature encoding ----------------------------------------------------------------------------

@dataclass(frozen=True)
class Encoding:
    """Fitted one-hot columns and scaler as one SQL projection to ``f0 .. fn``."""

    names: tuple[str, ...]
    stages: tuple

    @property
    def columns(self) -> list[str]:
        return [f"f{i}" for i in range(len(self.names))]

    def transform(self, df: DataFrame) -> DataFrame:
        return reduce(lambda rows, stage: stage.transform(rows), self.stages, df)


def fit_encoding(features: DataFrame, missing_dummy: float = 0.0, absent_dummy: float | None = None) -> Encoding:
    """Categories and population z-scores of the given rows.

    ``missing_dummy`` fills the columns of a row whose category was never seen; ``absent_dummy`` fills
    a column in all rows of a scored table of which none has its category.
    """
    values = categories(features, CATEGORICAL_FEATURES)
    raw = {c: f"CAST(`{c}` AS DOUBLE)" for c in NUMERIC_FEATURES}
    for name, sql in one_hot_expressions(values).items():
        raw[name] = f"CAST({sql} AS DOUBLE)"
    plain = features.selectExpr(*[f"{sql} AS `{name}`" for name, sql in raw.items()])
    stats = scaler_stats(plain, list(raw)).first()
    known = {c: ", ".join(map(_text, found)) for c, found in values.items()}
    terms = []
    for i, (name, sql) in enumerate(raw.items()):
        source = next((c for c in CATEGORICAL_FEATURES if name.startswith(f"{c}_")), None)
        if missing_dummy and source and known[source]:
            # A row whose category was never seen: the configured value in all its columns.
            sql = (
                f"CASE WHEN CAST(`{source}` AS STRING) IN ({known[source]}) THEN {sql}"
                f" ELSE {float(missing_dummy)!r}D END"
            )
        if absent_dummy is not None and source:
            value = _text(name.removeprefix(f"{source}_"))
            sql = f"CASE WHEN array_contains(`_present_{source}`, {value}) THEN {sql} ELSE {float(absent_dummy)!r}D END"
        terms.append(f"({sql} - ({stats[f'm{i}']!r}D)) / ({stats[f's{i}']!r}D) AS f{i}")
    if absent_dummy is None:
        return Encoding(tuple(raw), (SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__"),))
    helpers = ", ".join(f"_present_{c}" for c in CATEGORICAL_FEATURES)
    statement = f"SELECT * EXCEPT ({helpers}), {', '.join(terms)} FROM __THIS__"
    return Encoding(tuple(raw), (PresentCategories(columns=CATEGORICAL_FEATURES), SQLTransformer(statement=statement)))


def _text(value: str) -> str:
    """A value as SQL text."""
    quoted = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{quoted}'"


def labelled(features: DataFrame) -> DataFrame:
    return features.withColumn("label", flag(F.col(LABEL)))


def encode(encoding: Encoding, features: DataFrame) -> DataFrame:
    """``(id, label, f0 .. fn)``."""
    return encoding.transform(features).select("id", "label", *encoding.columns)


# --- comparison ----------------------------------------------------------------------------------

# The tree models of a comparison, with the library's own settings.
FORESTS = {
    "CART": forests.Forest(depth=MAX_DEPTH),
    "RF": forests.Forest(trees=20, drawn=True, depth=MAX_DEPTH),
}


def auc_of(scored: DataFrame) -> float:
    """Area under ROC, with the library's evaluator on exact thresholds."""
    rows = scored.select(F.col("label").cast("double").alias("label"), "score")
    return BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(rows)


def _scored_one_by_one(cells: list[tuple], columns: list[str], spark: SparkSession, parallelism: int) -> DataFrame:
    """``(cell, label, score)`` of the test rows of every ``(model, params, train, test)``.

    Fits are independent chains of small jobs: a bounded pool keeps the cluster busy between their
    stages. Scored rows are written cell by cell, so that one job can rate all of them.
    """
    folder = scratch_path(spark, "scored")

    def one(number: int) -> None:
        name, params, train, test = cells[number]
        scored = predict(fit_model(name, train, columns, params), test)
        rows = scored.select("label", F.col("score").cast("double").alias("score"))
        rows.write.parquet(f"{folder}/cell={number}")

    with ThreadPoolExecutor(parallelism) as pool:
        list(pool.map(one, range(len(cells))))
    schema = T.StructType.fromDDL("label int, score double, cell int")
    return spark.read.schema(schema).parquet(folder)


def _scored_together(name: str, train: DataFrame, test: DataFrame, columns: list[str]) -> DataFrame:
    """``(cell, label, score)`` of the test rows of all cells, by a model of each cell's train rows. The
    number of jobs does not depend on the number of cells."""
    if name == "KNN":
        scored = knn_classify(train, test, columns, groups=["cell"])
    elif name == "LDA":
        scored = grouped.linear_scores(test, columns, grouped.fit_discriminants(train, columns))
    elif name == "LogitReg":
        scored = grouped.linear_scores(test, columns, grouped.fit_logistic(train, columns))
    elif name == "SVM":
        mapping = grouped.CosineMap.draw(len(columns))
        scored = grouped.linear_scores(test, columns, grouped.fit_margins(train, columns, mapping), mapping, False)
    elif name == "XGB":
        scored = grouped.boosted_scores(test, columns, *grouped.fit_boosted(train, columns))
    else:
        raise ValueError(f"unknown model {name!r}: use one of {MODEL_NAMES}")
    return scored.select("cell", "label", "score")


def _rated(scored: DataFrame, names: list[tuple], ddl: str) -> DataFrame:
    """``test_rows``, ``positives`` and ``auc`` of every cell, in one grouped rank sum."""
    counts = scored.groupBy("cell").agg(
        F.count(F.lit(1)).alias("test_rows"), F.sum("label").cast("long").alias("positives")
    )
    rows = [(number, *name) for number, name in enumerate(names)]
    named = scored.sparkSession.createDataFrame(rows, f"cell int, {ddl}")
    rated = counts.join(metrics.roc_auc(scored, groups=["cell"]), "cell")
    return named.join(rated, "cell").drop("cell")


def _by_cell(df: DataFrame, name: str) -> DataFrame:
    """Written in a folder for each cell, in as many files as its size asks for: a fit of one cell reads
    that cell alone, and its tasks follow its rows, not the number of parts that shuffles have."""
    path = scratch_path(df.sparkSession, name)
    df.hint("rebalance", "cell").sortWithinPartitions("cell", "id").write.partitionBy("cell").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold_cells(
    data: DataFrame, columns: list[str], kinds: tuple, n_splits: int, resample_first: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows ``(cell, id, label, columns)`` of every way of balancing and fold; the cell is
    ``kind * n_splits + fold``.

    The train part of a fold is all other folds. They are balanced together: SMOTE searches the
    neighbours of all folds at once, and cleaning those of all that have grown.
    """
    def folded(rows: DataFrame) -> DataFrame:
        return materialise(rows.select("id", "label", *columns).withColumn("fold", fold_of("id", n_splits)), "folds")

    def rest_of(rows: DataFrame) -> DataFrame:
        others = F.filter(F.sequence(F.lit(0), F.lit(n_splits - 1)), lambda f: f != F.col("fold"))
        return rows.withColumn("fold", F.explode(others))

    whole = None if resample_first else folded(data)
    grown = None
    trains, tests = [], []
    for i, kind in enumerate(kinds):
        rows = folded(resample(data, kind, columns)) if resample_first else whole
        if resample_first or kind is None:
            train = rest_of(rows)
        elif kind == "under":
            train = resample(rest_of(rows), kind, columns, groups=["fold"])
        else:
            grown = grown or materialise(resample(rest_of(rows), "smote", columns, groups=["fold"]), "grown")
            train = grown if kind == "smote" else edited(grown, columns, groups=["fold"])
        number = (F.lit(i * n_splits) + F.col("fold")).cast("int").alias("cell")
        trains.append(train.select(number, F.col("id").cast("string").alias("id"), "label", *columns))
        tests.append(rows.select(number, F.col("id").cast("string").alias("id"), "label", *columns))
    return tuple(_by_cell(reduce(DataFrame.unionByName, parts), name)
                 for parts, name in ((trains, "cells-train"), (tests, "cells-test")))


def choose_sampling(
    data: DataFrame,
    columns: list[str],
    kinds=("under", "smote", "combine"),
    n_splits: int = 10,
    models: list[str] | None = None,
    resample_first: bool = False,
    parallelism: int = 8,
) -> DataFrame:
    """``(sampling, model, fold, test_rows, positives, auc)`` for every way of balancing the classes,
    model and fold; ``auc`` is NULL where a fold lacks a class.

    ``data`` is the train part. Folds come from a hash of the row id. Each fold's train part is
    balanced on its own, once for all models; with ``resample_first`` the rows are balanced once,
    before the folds are cut. Every model is fitted for all cells together.
    """
    models = models or MODEL_NAMES
    train, test = fold_cells(data, columns, kinds, n_splits, resample_first)
    cells = [(kind or "none", fold) for kind in kinds for fold in range(n_splits)]

    def together(number: int) -> DataFrame:
        found = _scored_together(models[number], train, test, columns)
        return materialise(found.withColumn("cell", F.col("cell") + number * len(cells)), "scored")

    def trees(numbers: list[int]) -> list[DataFrame]:
        sides = forests.packed_sides(train, test, columns)
        found = [(i, forests.scores(*sides, len(columns), FORESTS[models[i]])) for i in numbers]
        return [materialise(f.withColumn("cell", F.col("cell") + i * len(cells)), "scored") for i, f in found]

    # Chains of small jobs: a bounded pool keeps the cluster busy between their stages.
    grown = [i for i, name in enumerate(models) if name in FORESTS]
    jobs = [partial(trees, grown)] if grown else []
    jobs += [lambda i=i: [together(i)] for i, name in enumerate(models) if name not in FORESTS]
    with ThreadPoolExecutor(parallelism) as pool:
        scored = [s for found in pool.map(lambda job: job(), jobs) for s in found]
    rows = [s.select("cell", F.col("label").cast("int").alias("label"), "score") for s in scored]
    names = [(kind, name, fold) for name in models for kind, fold in cells]
    return _rated(reduce(DataFrame.unionByName, rows), names, "sampling string, model string, fold int")


def cv_auc_by_model(data: DataFrame, columns: list[str], sampling: str | None, **options) -> DataFrame:
    """The comparison of models for one way of balancing: see ``choose_sampling``."""
    return choose_sampling(data, columns, (sampling,), **options)


def auc_summary(scores: DataFrame) -> DataFrame:
    """Mean and population deviation of the folds' AUC, with what it rests on."""
    return scores.groupBy("sampling", "model").agg(
        F.count("fold").alias("folds"),
        F.sum("test_rows").alias("test_rows"),
        F.sum("positives").alias("positives"),
        F.round(F.avg("auc"), 4).alias("mean_auc"),
        F.round(F.stddev_pop("auc"), 3).alias("std_auc"),
    )


def grid_search(
    train: DataFrame, columns: list[str], name: str, grid: dict[str, list], n_splits: int = 5,
    parallelism: int = 8,
) -> tuple[object, dict, DataFrame]:
    """Best model of any kind, its parameters, and ``(params, folds, test_rows, positives, mean_auc)``
    for the whole grid."""
    spark = train.sparkSession
    maps = [dict(zip(grid, values)) for values in product(*grid.values())]
    folds = materialise(train.withColumn("fold", fold_of("id", n_splits)).hint("rebalance"), "folds")
    cells, names = [], []
    for i, params in enumerate(maps):
        for fold in range(n_splits):
            rest, test = (folds.where(c).drop("fold") for c in (F.col("fold") != fold, F.col("fold") == fold))
            cells.append((name, params, rest, test))
            names.append((i, str(sorted(params.items())), fold))
    rated = _rated(_scored_one_by_one(cells, columns, spark, parallelism), names, "at int, params string, fold int")
    table = materialise(rated.groupBy("at", "params").agg(
        F.count("fold").alias("folds"), F.sum("test_rows").alias("test_rows"),
        F.sum("positives").alias("positives"), F.avg("auc").alias("mean_auc"),
    ), "grid")
    # As many rows as the grid has points.
    best = table.orderBy(F.desc_nulls_last("mean_auc"), "at").first()["at"]
    return fit_model(name, train, columns, maps[best]), maps[best], table.drop("at")


# --- train and score -----------------------------------------------------------------------------

@dataclass(frozen=True)
class Trained:
    pipeline: PipelineModel  # feature table -> probability and prediction
    encoding: Encoding | SparseFeatures
    test_scored: DataFrame  # (id, label, score, prediction) of the untouched test part
    balance: DataFrame  # (stage, label, n)


def train_model(features: DataFrame, settings: ModelSettings = ModelSettings()) -> Trained:
    """Split, encode, balance the train part only, fit, and score the test part."""
    table = materialise(stratified_split(labelled(features), settings.test_size, settings.seed), "split")
    train, test = table.where("part = 'train'"), table.where("part = 'test'")
    fitted_on = table if settings.fit_on == "all" else train
    if settings.sparse:
        # Synthetic rows need dense columns.
        if settings.sampling not in (None, "under"):
            raise ValueError("sparse categories can be balanced by 'under' only")
        encoding = SparseFeatures.fit(fitted_on, NUMERIC_FEATURES, CATEGORICAL_FEATURES)
        encoded = encoding.transform(train).select("id", "label", "features")
        balanced = materialise(resample(encoded, settings.sampling, ["features"], settings.seed), "balanced")
        pipeline = PipelineModel([encoding, fit_sparse_model(settings.model, balanced, settings.params)])
    else:
        encoding = fit_encoding(fitted_on, settings.missing_dummy, settings.absent_dummy)
        encoded = encode(encoding, train)
        balanced = materialise(resample(encoded, settings.sampling, encoding.columns, settings.seed), "balanced")
        fitted = fit_model(settings.model, balanced, encoding.columns, settings.params)
        pipeline = PipelineModel([*encoding.stages, *fitted.stages])
    scored = predict(pipeline, test).select("id", "label", "score", "prediction")
    counts = [
        df.groupBy("label").agg(F.count(F.lit(1)).alias("n")).select(F.lit(stage).alias("stage"), "label", "n")
        for stage, df in (("before", train), ("after", balanced))
    ]
    return Trained(pipeline, encoding, scored, counts[0].unionByName(counts[1]))


def evaluate(trained: Trained) -> DataFrame:
    return metrics.classification_report(trained.test_scored)


def save_pipeline(trained: Trained, min_date: DataFrame, folder: str) -> None:
    """Model, encoding and the training minimum date under one folder."""
    trained.pipeline.write().overwrite().save(f"{folder}/pipeline")
    min_date.write.mode("overwrite").parquet(f"{folder}/min_date")


def load_pipeline(spark, folder: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{folder}/pipeline"), spark.read.parquet(f"{folder}/min_date")


def score_users(pipeline: PipelineModel, features: DataFrame) -> DataFrame:
    """Probability, class and action for every row of the feature table; fits nothing."""
    scored = predict(pipeline, features).withColumnRenamed("score", "probability")
    return decide_action(scored).select("id", "probability", "prediction", "action", "action_label")
