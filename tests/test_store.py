from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from watthour.operators import store as ops
from watthour.operators.scaling import fit_scaler
from watthour.schemas import DRIFT_LOG, PREDICTIONS, REFERENCE_DATA
from watthour.sources import tables


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def forecast(spark, *dates, model="m", power=1.0):
    rows = [(d, model, [power] * 24, power, 1, 24 * power, 13 * power, 31, datetime(2024, 1, 1), datetime(2024, 1, 1)) for d in dates]
    return spark.createDataFrame(rows, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PREDICTIONS.fields))


def test_save_predictions_refuses_taken_keys(spark, tmp_path):
    path = str(tmp_path / "predictions")
    tables.save_predictions(forecast(spark, date(2024, 1, 1), date(2024, 1, 2)), path)
    tables.save_predictions(forecast(spark, date(2024, 1, 1), model="other"), path)
    for bad in (forecast(spark, date(2024, 1, 2), date(2024, 1, 9)), forecast(spark, date(2024, 3, 1), date(2024, 3, 1))):
        with pytest.raises(RuntimeError, match="already exists"):
            tables.save_predictions(bad, path)
    got = tables.read_table(spark, path, PREDICTIONS)
    assert got.count() == 3 and got.where(F.size("forecast_24h") == 24).count() == 3


def test_required_columns(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.save_predictions(forecast(spark, date(2024, 1, 1)).drop("peak_power"), str(tmp_path / "p"))
    nulls = forecast(spark, date(2024, 1, 1)).withColumn("peak_power", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="must not be null"):
        tables.save_predictions(nulls, str(tmp_path / "p"))


def test_retention(spark, tmp_path):
    path = str(tmp_path / "predictions")
    assert tables.delete_old_predictions(spark, path, date(2024, 6, 30)) == 0
    tables.save_predictions(forecast(spark, date(2024, 1, 1), date(2024, 3, 31), date(2024, 4, 1)), path)
    rows = tables.read_table(spark, path, PREDICTIONS)
    split = ops.retention_split(rows, at("2024-06-30"), 90).first()
    assert (split["kept"], split["dropped"]) == (1, 2)
    assert ops.expired(rows, at("2024-06-30"), 90).count() == 2
    assert tables.delete_old_predictions(spark, path, date(2024, 6, 30), 90) == 2
    left = tables.read_table(spark, path, PREDICTIONS)
    assert [r["prediction_date"] for r in left.collect()] == [date(2024, 4, 1)]
    assert tables.delete_old_predictions(spark, path, date(2024, 6, 30), 90) == 0


def test_conflict_check_reads_only_the_incoming_dates(spark, tmp_path):
    path = str(tmp_path / "predictions")
    tables.save_predictions(forecast(spark, date(2024, 1, 1), date(2024, 1, 2)), path)
    one = tables.read_table(spark, path, PREDICTIONS).where(F.col("prediction_date").isin([date(2024, 1, 2)]))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(prediction_date" in plan or "prediction_date#" in plan.split("PartitionFilters")[1][:120]
    assert len(one.inputFiles()) >= 1 and one.count() == 1


def profile(spark, version, samples, stamp):
    return spark.createDataFrame([(stamp, "m", version, samples, 31, 24, stamp)],
                                 ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in REFERENCE_DATA.fields))


def test_upsert_is_idempotent_and_latest_is_found(spark, tmp_path):
    path = str(tmp_path / "reference")
    first, second = datetime(2024, 1, 1), datetime(2024, 2, 1)
    tables.upsert_table(profile(spark, "1", 10, first), path, REFERENCE_DATA)
    tables.upsert_table(profile(spark, "2", 20, second), path, REFERENCE_DATA)
    for _ in range(2):
        tables.upsert_table(profile(spark, "1", 15, first), path, REFERENCE_DATA)
    got = tables.read_version(spark, path, REFERENCE_DATA)
    assert {(r["model_version"], r["training_samples"]) for r in got.collect()} == {("1", 15), ("2", 20)}
    assert ops.select_profile(got, "m").first()["model_version"] == "2"
    assert ops.select_profile(got, "m", "1").first()["training_samples"] == 15
    assert ops.select_profile(got, "nobody").isEmpty()
    assert [r["model_version"] for r in ops.list_profiles(got).collect()] == ["2", "1"]


def test_upsert_matches_a_missing_version_with_itself(spark):
    old = spark.createDataFrame([("m", None, 1), ("m", "1", 1)], "model_name string, model_version string, n int")
    new = spark.createDataFrame([("m", None, 2)], "model_name string, model_version string, n int")
    got = {(r["model_version"], r["n"]) for r in ops.upsert(old, new, ["model_name", "model_version"]).collect()}
    assert got == {(None, 2), ("1", 1)}


def test_unfinished_version_is_ignored(spark, tmp_path):
    path = tmp_path / "t"
    assert tables.current_version(spark, str(path)) == 0
    (path / "version=3").mkdir(parents=True)
    assert tables.current_version(spark, str(path)) == 0


def test_append_log(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([("d", "f", 1.0, False)], "dataset_name string, feature_name string, drift_score double, drift_detected boolean")
    assert tables.read_table(spark, path, DRIFT_LOG).count() == 0
    tables.append(rows, path, DRIFT_LOG)
    tables.append(rows, path, DRIFT_LOG)
    assert tables.read_table(spark, path, DRIFT_LOG).count() == 2


def test_fitted_parameters_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 9.0)], "x double, y double")
    params, path = fit_scaler(df, ["x", "y"]), str(tmp_path / "params")
    with pytest.raises(RuntimeError):
        tables.load_params(spark, path)
    tables.save_params(params, path)
    assert sorted(tables.load_params(spark, path).collect()) == sorted(params.collect())


def test_keep_latest_n(spark):
    rows = [("m", v, s) for v, s in enumerate(["None", "Archived", "Production", "None", "None", "Staging", "None"], start=1)]
    df = spark.createDataFrame(rows + [("k", 1, "None")], "model string, version int, stage string")
    got = {(r["model"], r["version"]) for r in ops.keep_latest_n(df, ["model"], ["version"], "stage", 3).where("to_archive").collect()}
    assert got == {("m", 1), ("m", 4)}


def test_latest_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v").repartition(4)
    plan = ops.latest_by(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert {r["v"] for r in ops.latest_by(df, ["k"], ["v"]).collect()} == {997, 998, 999}


def test_recent_predictions(spark):
    rows = forecast(spark, date(2024, 1, 1), date(2024, 1, 8), date(2024, 1, 9))
    got = ops.recent_predictions(rows, at("2024-01-15 10:00:00"), 7)
    assert [r["prediction_date"].day for r in got.collect()] == [9, 8]
    assert ops.recent_predictions(rows, at("2024-01-15"), 7, "other").isEmpty()


def test_json_round_trip(spark):
    df = forecast(spark, date(2024, 1, 1))
    text = ops.forecast_json(df)
    assert text.first()["forecast_24h"].startswith("[1.0,")
    assert ops.forecast_from_json(text).first()["forecast_24h"] == [1.0] * 24


def test_metrics_long(spark):
    df = spark.createDataFrame([("m", 1.5, 2)], "model_name string, rmse double, n int")
    got = {(r["metric_name"], r["metric_value"]) for r in ops.metrics_long(df, ["rmse", "n"], ["model_name"]).collect()}
    assert got == {("rmse", 1.5), ("n", 2.0)}
