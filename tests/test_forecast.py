from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from frames import START, series, solar_days
from watthour.operators import forecast as ops
from watthour.operators.features import lag_features
from watthour.operators.models import fit_horizons
from watthour.operators.features import target_names
from watthour.plans.daily import drift_check, model_forecast, naive_run
from watthour.plans.training import fit_dataset
from watthour.operators.profile import drift_reference, profile_numeric

DAY = lambda n: date(2024, 1, n)


def test_midnight_row_is_not_its_own_history(spark):
    rows = ops.midnight_features(series(spark, range(50)), DAY(2), DAY(4), lag_days=(1,), rolling_days=(1,))
    got = {r["prediction_date"]: r for r in rows.collect()}
    # readings run to Jan 3 01:00; the row at 00:00 belongs to the day it starts
    assert got[DAY(2)]["anchor_ts"] == datetime(2024, 1, 1, 23)
    assert got[DAY(3)]["anchor_ts"] == datetime(2024, 1, 2, 23)
    assert got[DAY(4)]["anchor_ts"] == datetime(2024, 1, 3, 1)
    assert got[DAY(3)]["ac_power_lag_1d"] == 23.0
    assert got[DAY(3)]["hour_of_day"] == 12 and got[DAY(3)]["day_of_year"] == 3


def test_one_row_serves_every_midnight_of_a_long_gap(spark):
    skip = set(range(30, 100))
    rows = ops.midnight_features(series(spark, range(40), skip=skip), DAY(1), DAY(7), lag_days=(1,), rolling_days=(1,))
    got = {r["prediction_date"]: r["anchor_ts"] for r in rows.collect()}
    assert DAY(1) not in got
    assert got[DAY(3)] == got[DAY(4)] == got[DAY(5)] == datetime(2024, 1, 2, 5)
    assert got[DAY(6)] == got[DAY(7)] == START + timedelta(hours=109)
    with pytest.raises(ValueError):
        ops.require_history(rows, [DAY(1), DAY(3)])
    ops.require_history(rows, [DAY(3)])


def test_features_match_the_ordinary_ones(spark):
    hourly = series(spark, [i * 31 % 17 for i in range(500)], key="p")
    features = ops.midnight_features(hourly, DAY(5), DAY(20), keys=["plant"], lag_days=(1, 2), rolling_days=(2,))
    plain = lag_features(hourly, keys=["plant"], lag_days=(1, 2), rolling_days=(2,))
    joined = features.join(plain.withColumnRenamed("date_time", "anchor_ts").select(
        "anchor_ts", *[F.col(c).alias(f"p_{c}") for c in ("ac_power_lag_2d", "rolling_std_2d")]), "anchor_ts")
    assert joined.count() == 16
    assert joined.where(~F.col("ac_power_lag_2d").eqNullSafe(F.col("p_ac_power_lag_2d"))).count() == 0
    assert joined.where(~F.col("rolling_std_2d").eqNullSafe(F.col("p_rolling_std_2d"))).count() == 0


def test_naive_forecast_repeats_the_last_day(spark):
    hourly = series(spark, range(72))
    steps = ops.forecast_steps(ops.naive_forecast(hourly, DAY(2), DAY(4)), ["prediction_date"])
    day3 = steps.where(F.col("prediction_date") == DAY(3)).orderBy("horizon").collect()
    assert [r["y_hat"] for r in day3] == [float(v) for v in range(24, 48)]
    assert day3[0]["target_ts"] == datetime(2024, 1, 3, 0) and day3[-1]["target_ts"] == datetime(2024, 1, 3, 23)
    pairs = ops.forecast_vs_actual(steps, hourly, ["prediction_date"])
    # Jan 4 has no actuals
    assert {r[0] for r in pairs.select("prediction_date").distinct().collect()} == {DAY(2), DAY(3)}
    accuracy = ops.forecast_day_accuracy(pairs, ["prediction_date"]).where(F.col("prediction_date") == DAY(2)).first()
    assert accuracy["rmse"] == 24.0 and accuracy["actual_peak"] == 47.0
    assert ops.daylight_slice(pairs, "target_ts").count() == 26


def test_a_day_with_a_missing_hour_has_no_comparison(spark):
    hourly = series(spark, range(71), skip={30})
    steps = ops.forecast_steps(ops.naive_forecast(hourly, DAY(2), DAY(3)), ["prediction_date"])
    pairs = ops.forecast_vs_actual(steps, hourly, ["prediction_date"])
    assert {r[0] for r in pairs.select("prediction_date").distinct().collect()} == {DAY(3)}


def test_day_metrics(spark):
    power = [0.0] * 6 + [1.0] * 13 + [0.5] * 5
    power[11] = power[12] = 9.0
    row = ops.forecast_day_metrics(spark.createDataFrame([(power,)], "forecast_24h array<double>")).first()
    assert (row["peak_power"], row["peak_hour"]) == (9.0, 12)
    assert (row["total_energy"], row["daylight_energy"], row["night_energy"]) == (31.5, 29.0, 2.5)


def test_validation(spark):
    df = spark.createDataFrame([([1.0] * 24,), ([1.0] * 12,), ([-1.0, 2000.0] + [0.0] * 22,)], "forecast_24h array<double>")
    rows = ops.forecast_validate(df).collect()
    assert [r["validation_passed"] for r in rows] == [True, False, True]
    assert rows[0]["negative_predictions"] == 0
    assert rows[1]["error"] == "Invalid forecast length: 12, expected 24"
    assert (rows[2]["negative_predictions"], rows[2]["high_power"], rows[2]["max_power"]) == (1, True, 2000.0)
    with pytest.raises(ValueError, match="Invalid forecast length: 12, expected 24"):
        ops.forecast_validate(df, strict=True)


def test_naive_run_for_two_plants(spark):
    hourly = series(spark, range(80), key="a").unionByName(series(spark, range(10), key="b"))
    rows = naive_run(hourly, DAY(2), DAY(4), F.lit("2024-01-04").cast("timestamp_ntz"), keys=["plant"])
    got = {(r["plant"], r["prediction_date"]): r for r in rows.collect()}
    assert set(got) == {(p, DAY(d)) for p in "ab" for d in (2, 3, 4)}
    assert got["a", DAY(3)]["total_energy"] == sum(range(24, 48))


def test_model_run_and_drift_check(spark):
    hourly = spark.createDataFrame(solar_days(45), "date_time timestamp_ntz, ac_power double")
    rows, fitted = fit_dataset(hourly, lag_days=(1, 2, 7), rolling_days=(7,))
    targets = {h: target_names()[h - 1] for h in (1, 12)}
    models = fit_horizons(rows, fitted.features, targets, {"trees": 3, "depth": 3, "rate": 0.3, "rows": 1.0, "columns": 1.0})
    features, forecasts = model_forecast(hourly, date(2020, 6, 10), date(2020, 6, 12), fitted, models,
                                         calendar_at="anchor")
    got = forecasts.orderBy("prediction_date").collect()
    assert len(got) == 3 and all(len(r["forecast_24h"]) == 2 for r in got)
    # hour 0 is dark, hour 11 is bright
    assert all(r["forecast_24h"][0] < 200 < r["forecast_24h"][1] for r in got)
    reference = drift_reference(profile_numeric(rows.select(*fitted.features)))
    log = drift_check(features, reference, F.lit("2020-06-12").cast("timestamp_ntz"))
    assert log.columns == ["timestamp", "dataset_name", "feature_name", "drift_score", "drift_detected"]
    assert log.count() > 20
