"""Load layer over raw files, and the whole job from files to actions."""

import datetime as dt
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import job
from ledgerlens.plans.models import MODEL_NAMES
from ledgerlens.registry.data import Data, write_raw_csv
from ledgerlens.session import drop, materialise, scratch_path, shared_dir
from ledgerlens.settings import TABLE_COLUMNS, JobSettings
from ledgerlens.sources import checks, files, load, schemas


def write_raw_files(d, raw, transactions=None, currencies=None):
    currencies = d.currency_details if currencies is None else currencies
    write_raw_csv(d.users.drop("is_fraudster"), f"{raw}/train_users.csv")
    write_raw_csv(d.fraudsters, f"{raw}/train_fraudsters.csv")
    write_raw_csv(d.raw_transactions if transactions is None else transactions, f"{raw}/train_transactions.csv")
    write_raw_csv(d.countries, f"{raw}/countries.csv")
    write_raw_csv(currencies.withColumnRenamed("ccy", "currency"), f"{raw}/currency_details.csv")
    write_raw_csv(d.fx_wide, f"{raw}/fx_rates.csv")


def put(spark, lines):
    path = scratch_path(spark, "text")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_scan_csv_by_name_with_gaps(spark):
    schema = T.StructType([
        T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType()),
        T.StructField("c", T.StringType()), T.StructField("d", T.TimestampNTZType()),
    ])
    path = put(spark, ["C;EXTRA;A;B;D", " x ;1;36.0;NaN;2020-01-01 10:00:00", ";2;;1.5;"])
    rows = sorted((tuple(r) for r in files.scan_csv(spark, path, schema, ";").collect()), key=str)
    assert rows == sorted([(36, None, " x ", dt.datetime(2020, 1, 1, 10)), (None, 1.5, None, None)], key=str)


def test_scan_csv_with_line_breaks_and_quotes_in_cells(spark):
    texts = ["plain", "two\nlines", 'a "quoted" word', "three\n\nlines, and a comma", 'ends with "', "last\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "a int, b string")
    path = scratch_path(spark, "breaks")
    quoted = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.repartition(3).write.options(**quoted).csv(path)
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    assert files.has_quoted_breaks(spark, path)
    assert sorted(tuple(r) for r in files.scan_csv(spark, path, schema).collect()) == list(enumerate(texts))
    tidy = scratch_path(spark, "tidy")
    df.where("a in (0, 2)").write.options(**quoted).csv(tidy)
    assert not files.has_quoted_breaks(spark, tidy)
    assert sorted(tuple(r) for r in files.scan_csv(spark, tidy, schema).collect()) == [(0, texts[0]), (2, texts[2])]


def test_scan_csv_refuses_bad_cells(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    with pytest.raises(Exception):
        files.scan_csv(spark, put(spark, ["a", "x1"]), schema).collect()


def test_catalog_tables(spark):
    name = "ledgerlens_replace_test"
    files.create_all(spark, {name: schemas.FX_RATES.struct})
    files.create_table(spark, name, schemas.FX_RATES.struct)  # there already: nothing happens
    assert spark.table(name).count() == 0 and spark.table(name).columns == TABLE_COLUMNS["fx_rates"]
    files.replace_table(spark, name, spark.range(3))
    assert spark.table(name).count() == 3
    files.drop_all(spark, [name])
    assert not spark.catalog.tableExists(name)


def test_constraint_violations_are_counted(spark):
    rows = [("EUR", 1, 2, False), ("EUR", 1, 2, None), ("X" * 11, None, None, True)]
    df = spark.createDataFrame(rows, "ccy string, iso_code int, exponent int, is_crypto boolean")
    found = {(r.column_name, r.rule): r.violations
             for r in checks.validate_constraints([(df, schemas.CURRENCY_DETAILS)]).collect()}
    assert found == {("ccy", "not_null"): 0, ("is_crypto", "not_null"): 1, ("ccy", "max_length"): 1,
                     ("ccy", "primary_key"): 1}


def currencies(spark, rows):
    return spark.createDataFrame(rows, "ccy string, iso_code int, exponent int, is_crypto boolean")


def test_a_table_is_published_only_when_clean(spark):
    path = f"{scratch_path(spark, 'wh')}/currency_details"
    good = [("EUR", 1, 2, False), ("USD", 2, 2, False)]
    row = load.reconcile_counts(currencies(spark, good), "currency_details", path).first()
    assert tuple(row) == ("currency_details", 2, 2, True, 0)
    bad = [("EUR", 1, 2, False), ("EUR", 1, 2, None), ("X" * 11, None, None, True)]
    with pytest.raises(load.ConstraintViolation) as refused:
        load.reconcile_counts(currencies(spark, bad), "currency_details", path)
    assert sorted(refused.value.found) == [
        ("currency_details", "ccy", "max_length", 1), ("currency_details", "ccy", "primary_key", 1),
        ("currency_details", "is_crypto", "not_null", 1)]
    assert sorted(r.ccy for r in spark.read.parquet(path).collect()) == ["EUR", "USD"]
    load.reconcile_counts(currencies(spark, [("GBP", 3, 2, False)]), "currency_details", path)
    assert [r.ccy for r in spark.read.parquet(path).collect()] == ["GBP"]
    # Neither staged nor replaced folders stay behind.
    assert os.listdir(os.path.dirname(path)) == ["currency_details"]


def test_one_bad_file_stops_the_whole_load(spark, sf_dir):
    d = Data(spark, sf_dir)
    raw, warehouse = scratch_path(spark, "raw"), scratch_path(spark, "warehouse")
    write_raw_files(d, raw)
    settings = JobSettings.for_folders(raw, warehouse, scratch_path(spark, "model"))
    assert all(r.ok and r.violations == 0 for r in load.load_all_tables(spark, settings).collect())
    before = {n: spark.read.parquet(f"{warehouse}/{n}").count() for n in TABLE_COLUMNS}
    repeated = d.raw_transactions.unionByName(d.raw_transactions.limit(3))
    changed = scratch_path(spark, "changed")
    write_raw_files(d, changed, transactions=repeated, currencies=d.currency_details.limit(2))
    with pytest.raises(load.ConstraintViolation) as refused:
        load.load_all_tables(spark, JobSettings.for_folders(changed, warehouse, "unused"))
    assert refused.value.found == [("transactions", "id", "primary_key", 3)]
    assert before == {n: spark.read.parquet(f"{warehouse}/{n}").count() for n in TABLE_COLUMNS}
    assert sorted(os.listdir(warehouse)) == sorted(TABLE_COLUMNS)


def test_scratch_space_is_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_dir(spark) == configured


def test_job_from_files_to_actions(spark, sf_dir, capsys):
    d = Data(spark, sf_dir)
    raw, warehouse, model = (scratch_path(spark, n) for n in ("raw", "warehouse", "model"))
    write_raw_files(d, raw)
    folders = ["--data", raw, "--warehouse", warehouse, "--model", model]
    job.main(["--type", "load_db", *folders])
    settings = job.settings_from(job.parse_arguments(folders))
    tables = job.tables(spark, settings)
    assert tables["users"].count() == 150 and tables["transactions"].count() == 1500
    assert tables["users"].where("is_fraudster").count() == d.fraudsters.count()
    report = spark.read.parquet(f"{warehouse}/report")
    assert sorted(int(r.user_id) for r in report.collect()) == sorted(
        r.user_id for r in job.run_report(spark, settings).select(F.col("user_id").cast("int").alias("user_id")).collect())
    job.main(["--type", "model", "--key", "7", "8", "missing", *folders])
    out = capsys.readouterr().out
    assert "f1" in out and "action_label" in out
    job.main(["--type", "load_db", "--only", "fx_rates", *folders])
    keys = spark.createDataFrame([("7",), ("8",), ("missing",)], "id string")
    for name in MODEL_NAMES:
        # Each kind of model is trained, stored, loaded and scored with by the job's own steps.
        chosen = replace(settings, model=replace(settings.model, model=name, sampling="under", params={}), model_dir=f"{model}-{name}")
        assert job.run_training(spark, chosen).where("metric = 'f1'").count() == 4
        assert sorted(r.id for r in job.run_scoring(spark, chosen, keys).collect()) == ["7", "8"]
    scored = job.run_scoring(spark, settings, keys).collect()
    assert sorted(r.id for r in scored) == ["7", "8"]
    assert all(0 <= r.probability <= 1 and r.action in ("BOTH", "ALERT", "NOTHING") for r in scored)


def test_drop_removes_scratch_tables_alone(spark, tmp_path):
    kept = str(tmp_path / "own")
    spark.range(3).write.parquet(kept)
    scratch = materialise(spark.range(5), "drop me")
    drop(scratch, spark.read.parquet(kept))
    assert spark.read.parquet(kept).count() == 3
    with pytest.raises(Exception, match="(?i)not.*exist|not.*found"):
        scratch.count()
