"""Entry point for spark-submit: load the tables, run the report, train and score.

    spark-submit --py-files ledgerlens.zip ledgerlens/job.py --type all --data DIR --warehouse DIR \
        --model DIR [--key ID ...] [--mode train|predict]
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.operators.features import (
    min_created_date,
    user_feature_table,
    user_feature_table_by_key,
)
from ledgerlens.plans import training
from ledgerlens.plans.report import users_first_tx_over_10usd
from ledgerlens.session import build_session, materialise
from ledgerlens.settings import TABLE_COLUMNS, JobSettings
from ledgerlens.sources.files import scan_table, write_table
from ledgerlens.sources.load import load_all_tables


def tables(spark: SparkSession, settings: JobSettings) -> dict[str, DataFrame]:
    return {
        name: scan_table(spark, f"{settings.warehouse}/{name}", columns)
        for name, columns in TABLE_COLUMNS.items()
    }


def run_load(spark: SparkSession, settings: JobSettings) -> DataFrame:
    return load_all_tables(spark, settings)


def run_report(spark: SparkSession, settings: JobSettings) -> DataFrame:
    t = tables(spark, settings)
    return users_first_tx_over_10usd(t["transactions"], t["fx_rates"], t["currency_details"])


def run_training(spark: SparkSession, settings: JobSettings) -> DataFrame:
    """Train, save, and return the test report."""
    t = tables(spark, settings)
    start = min_created_date(t["users"])
    features = materialise(
        user_feature_table(t["users"], t["transactions"], t["fx_rates"], t["currency_details"], start),
        "features",
    )
    trained = training.train_model(features, settings.model)
    training.save_pipeline(trained, start, settings.model_dir)
    return training.evaluate(trained)


def run_scoring(spark: SparkSession, settings: JobSettings, keys: DataFrame | None = None) -> DataFrame:
    """Actions for the given users, or for all, with the saved model and its minimum date."""
    t = tables(spark, settings)
    pipeline, start = training.load_pipeline(spark, settings.model_dir)
    source = (t["users"], t["transactions"], t["fx_rates"], t["currency_details"])
    if keys is None:
        features = user_feature_table(*source, start)
    else:
        features = user_feature_table_by_key(*source, keys, start)
    return training.score_users(pipeline, features)


def parse_arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Load tables, report, train and score")
    parser.add_argument("-t", "--type", default="all", choices=["all", "load_db", "model"])
    parser.add_argument("-k", "--key", nargs="*", default=[], help="users to score; all without it")
    parser.add_argument("--mode", default="train", choices=["train", "predict"])
    parser.add_argument("--data", required=True, help="folder of the raw files")
    parser.add_argument("--warehouse", required=True, help="folder of the tables")
    parser.add_argument("--model", required=True, help="folder of the model")
    parser.add_argument("--only", nargs="*", help="load only these tables, count the others")
    return parser.parse_args(argv)


def settings_from(args: argparse.Namespace) -> JobSettings:
    settings = JobSettings.for_folders(args.data, args.warehouse, args.model)
    settings = replace(settings, model=replace(settings.model, mode=args.mode))
    if args.only is not None:
        chosen = {n: replace(t, insert=n in args.only) for n, t in settings.tables.items()}
        settings = replace(settings, tables=chosen, insert_all=False)
    return settings


def main(argv: list[str] | None = None) -> None:
    args = parse_arguments(argv)
    settings = settings_from(args)
    spark = build_session("ledgerlens")
    if args.type in ("all", "load_db"):
        run_load(spark, settings).show(truncate=False)
        run_report(spark, settings).write.mode("overwrite").parquet(f"{settings.warehouse}/report")
    if args.type in ("all", "model"):
        if settings.model.mode == "train":
            run_training(spark, settings).show(100, truncate=False)
        keys = spark.createDataFrame([(k,) for k in args.key], "id string") if args.key else None
        scores = f"{settings.warehouse}/scores"
        write_table(run_scoring(spark, settings, keys), scores)
        spark.read.parquet(scores).show(truncate=False)  # a first look; all rows are in the folder


if __name__ == "__main__":
    main()
