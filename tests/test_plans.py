from datetime import date

import pytest
from pyspark.sql import functions as F

from frames import series, solar_days
from watthour.operators.explore import time_slice
from watthour.operators.features import target_names
from watthour.operators.models import fit_horizons
from watthour.operators.store import performance_rows
from watthour.plans.daily import daily_run, naive_run, quick_drift_check
from watthour.plans.training import collect_reference, fit_dataset
from watthour.schemas import DRIFT_LOG, MODEL_PERFORMANCE
from watthour.sources import tables

SCHEMA = "plant string, date_time timestamp_ntz, ac_power double"


def at(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def hourly(spark):
    rows = [(p, t, v * k) for p, k in (("a", 1.0), ("b", 0.5)) for t, v in solar_days(24)]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def fitted(hourly):
    rows, fit = fit_dataset(hourly, keys=["plant"], lag_days=(1, 2), rolling_days=(2,))
    return rows.cache(), fit


def test_a_run_stores_forecasts_of_all_series_once(spark, tmp_path, hourly, fitted):
    rows, fit = fitted
    targets = {h: target_names()[h - 1] for h in (1, 2)}
    two = fit_horizons(rows, fit.features, targets, {"trees": 2, "depth": 3, "rate": 0.5, "rows": 1.0, "columns": 1.0})
    models = {h: two[1 + h % 2] for h in range(1, 25)}
    path, log = str(tmp_path / "predictions"), str(tmp_path / "log")
    reference = collect_reference(rows, fit.features, target_names())["drift_reference"]
    run = lambda: daily_run(hourly, date(2020, 5, 24), date(2020, 5, 25), fit, models, "trees", at("2020-05-24"),
                            path, reference, log, keys=["plant"])
    got = run().collect()
    assert {(r["plant"], r["prediction_date"].day) for r in got} == {("a", 24), ("a", 25), ("b", 24), ("b", 25)}
    schema = tables.predictions_schema(hourly, ["plant"])
    stored = tables.read_table(spark, path, schema)
    assert stored.count() == 4 and stored.first()["features_count"] == len(fit.features)
    assert tables.read_table(spark, log, DRIFT_LOG).count() > 10
    with pytest.raises(RuntimeError, match="already exists"):
        run()
    short = {h: two[1] for h in range(1, 13)}
    with pytest.raises(ValueError, match="Invalid forecast length: 12, expected 24"):
        daily_run(hourly, date(2020, 5, 24), date(2020, 5, 24), fit, short, "short", at("2020-05-24"), path, keys=["plant"])


def test_a_short_series_is_reported_and_a_date_without_history_raises(spark, tmp_path, hourly, fitted):
    rows, fit = fitted
    model = fit_horizons(rows, fit.features, {1: target_names()[0]}, {"trees": 2, "depth": 2, "rate": 0.5, "rows": 1.0, "columns": 1.0})[1]
    models = {h: model for h in range(1, 25)}
    short = spark.createDataFrame([("c", t, v) for t, v in solar_days(24)[-30:]], SCHEMA)
    path = str(tmp_path / "predictions")
    got = daily_run(hourly.union(short), date(2020, 5, 25), date(2020, 5, 25), fit, models, "trees", at("2020-05-25"), path, keys=["plant"])
    got = {r["plant"]: r for r in got.collect()}
    assert set(got) == {"a", "b", "c"} and got["a"]["reason"] is None and len(got["a"]["forecast_24h"]) == 24
    assert got["c"]["forecast_24h"] is None and "ac_power_lag_2d" in got["c"]["reason"]
    assert tables.read_table(spark, path, tables.predictions_schema(hourly, ["plant"])).count() == 2
    with pytest.raises(ValueError, match="no history before midnight of 2019-01-01"):
        daily_run(hourly, date(2019, 1, 1), date(2019, 1, 1), fit, models, "trees", at("2020-05-25"), path, keys=["plant"])


def test_reference_tables_by_version(spark, tmp_path, fitted):
    rows, fit = fitted
    path = str(tmp_path / "reference")
    assert tables.load_drift_reference(spark, path, "m") is None
    reference = {k: v.cache() for k, v in collect_reference(rows, fit.features[:4], target_names(2)).items()}
    tables.save_reference(reference, path, "m", "1", at("2024-01-01"))
    tables.save_reference(reference, path, "m", "2", at("2024-01-02"))
    tables.save_reference(reference, path, "m", "1", at("2024-01-03"))
    newest = tables.load_drift_reference(spark, path, "m")
    assert newest.count() == 4 and newest.first()["model_version"] == "1"
    assert tables.load_drift_reference(spark, path, "m", "2").count() == 4
    summary = quick_drift_check(rows.select(*fit.features[:4]), newest, at("2024-01-04"), str(tmp_path / "log")).first()
    assert (summary["features_analyzed"], summary["overall_drift_detected"], summary["drift_detection_failed"]) == (4, False, False)
    assert tables.read_table(spark, str(tmp_path / "log"), DRIFT_LOG).count() == 4


def test_no_reference_is_a_status_not_a_failure(spark, tmp_path, fitted):
    log = str(tmp_path / "log")
    row = quick_drift_check(fitted[0].select("hour_sin"), None, at("2024-01-04"), log).first()
    assert row["drift_detection_failed"] and row["reason"] == "no_reference_data"
    assert not row["overall_drift_detected"] and not tables.exists(spark, log)


def test_metric_log(spark, tmp_path):
    metrics = spark.createDataFrame([("rmse", 175.2), ("r2", 0.7)], "metric_name string, metric_value double")
    path = str(tmp_path / "performance")
    tables.append(performance_rows(metrics, "m", None, at("2024-01-01"), {"run": "7"}), path, MODEL_PERFORMANCE)
    got = tables.read_table(spark, path, MODEL_PERFORMANCE).collect()
    assert {r["metric_name"] for r in got} == {"rmse", "r2"} and got[0]["metadata"] == '{"run":"7"}'


def test_time_slice_includes_both_ends(spark):
    got = time_slice(series(spark, range(10)), at("2024-01-01 02:00:00"), at("2024-01-01 04:00:00"))
    assert sorted(r["ac_power"] for r in got.collect()) == [2.0, 3.0, 4.0]


def test_short_history_gives_flagged_baseline(spark):
    rows = naive_run(series(spark, range(5)), date(2024, 1, 2), date(2024, 1, 2), at("2024-01-02")).collect()
    assert len(rows) == 1 and rows[0]["forecast_length"] == 24
