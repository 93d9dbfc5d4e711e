import numpy as np
import pytest
from pyspark.sql import functions as F

from frames import series, solar_days
from watthour.operators import dataset as ops
from watthour.operators.features import check_settings, target_names
from watthour.operators.scaling import apply_scaler, fit_scaler
from watthour.plans.training import collect_reference, fit_dataset, transform

SCHEMA = "date_time timestamp_ntz, ac_power double"


@pytest.fixture(scope="module")
def days45(spark):
    return spark.createDataFrame(solar_days(45), SCHEMA).cache()


@pytest.fixture(scope="module")
def fitted(days45):
    rows, fit = fit_dataset(days45, lag_days=(1, 2, 7), rolling_days=(7,))
    return rows.cache(), fit


def test_forty_five_days(fitted):
    rows, fit = fitted
    assert rows.count() == 1080 - 336 - 24
    assert [c for c in rows.columns if c in target_names()] == target_names()
    # 3 lags, 3 rolling, 3 same-hour, 15 calendar, 4 seasons
    assert len(fit.features) == 28
    assert fit.families == {"total_features": 28, "lag_features": 3, "rolling_features": 3,
                            "temporal_features": sum(any(t in f for t in ("hour", "day", "month", "season"))
                                                     for f in fit.features)}


def test_scaled_columns_have_mean_zero_and_spread_one(fitted):
    rows, _ = fitted
    row = rows.agg(F.avg("ac_power_lag_1d").alias("m"), F.stddev_pop("ac_power_lag_1d").alias("s"),
                   F.max(F.abs("is_weekend")).alias("w")).first()
    assert row["m"] == pytest.approx(0, abs=1e-9) and row["s"] == pytest.approx(1)
    assert row["w"] > 0


def test_default_lags_need_more_than_thirty_one_days(spark):
    assert ops.forecast_dataset(spark.createDataFrame(solar_days(31), SCHEMA)).count() == 0


def test_two_rows_fail(spark):
    with pytest.raises(ValueError):
        fit_dataset(series(spark, [1, 2]), lag_days=(1,), rolling_days=(7,))


@pytest.mark.parametrize("settings", [dict(horizon=0, lag_days=(1,)), dict(horizon=1, lag_days=()),
                                      dict(horizon=1, lag_days=(1, -2)), dict(horizon=1, lag_days=(1,), rolling_days=(0,))])
def test_settings_are_checked(settings):
    with pytest.raises(ValueError):
        check_settings(**settings)


def test_unknown_scaling_method(days45):
    with pytest.raises(ValueError):
        fit_dataset(days45, method="robust")


def test_transform_equals_fit_on_the_same_rows(days45, fitted):
    rows, fit = fitted
    again = transform(days45, fit)
    assert again.columns == ["date_time", *fit.features]
    # without targets the last day stays
    assert again.count() == 1080 - 336
    shared = again.join(rows.select("date_time", F.col("rolling_std_7d").alias("other")), "date_time")
    assert shared.agg(F.max(F.abs(F.col("rolling_std_7d") - F.col("other")))).first()[0] < 1e-12
    with pytest.raises(RuntimeError):
        transform(days45, None)


def test_alignment(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "date_time int, b double, extra double")
    row = ops.align_columns(df, ["a", "b", "season_summer"]).first()
    assert row.asDict() == {"date_time": 1, "a": 0, "b": 2.0, "season_summer": False}


def test_scalers(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (2.0, 5.0, None), (6.0, 5.0, None)], "x double, k double, n double")
    params = fit_scaler(df, ["x", "k", "n"])
    x = np.array([1, 2, 6.0])
    standard = apply_scaler(df, params).collect()
    np.testing.assert_allclose([r["x"] for r in standard], (x - x.mean()) / x.std())
    assert {r["k"] for r in standard} == {0.0} and {r["n"] for r in standard} == {None}
    minmax = apply_scaler(df, params, "minmax").collect()
    np.testing.assert_allclose([r["x"] for r in minmax], (x - 1) / 5)
    assert {r["k"] for r in minmax} == {0.0}
    assert apply_scaler(df, params, "none").collect() == df.collect()


def test_split_at_the_floor(spark):
    got = ops.train_test_split(series(spark, range(14)))
    assert got.where("split = 'train'").count() == 11
    assert got.where("split = 'train'").agg(F.max("ac_power")).first()[0] == 10.0


def test_folds(spark):
    folds = ops.cv_folds(series(spark, range(40)), splits=3, test_rows=7)
    ranges = {(r["fold"], r["role"]): (r["rows"], r["first_ts"].hour + 24 * (r["first_ts"].day - 1))
              for r in ops.fold_ranges(folds).collect()}
    assert ranges == {(1, "train"): (19, 0), (1, "test"): (7, 19), (2, "train"): (26, 0), (2, "test"): (7, 26),
                      (3, "train"): (33, 0), (3, "test"): (7, 33)}
    assert ops.cv_folds(series(spark, range(40)), min_train_rows=20).where("fold = 1").count() == 0


def test_reference_of_a_training_frame(fitted):
    rows, fit = fitted
    tables = collect_reference(rows, fit.features, target_names())
    assert tables["feature_profile"].count() == 28
    assert tables["data_quality"].first()["features_constant"] >= 1
    assert tables["target_profile_by_horizon"].count() == 24
    same = {(r["feature_1"], r["feature_2"]) for r in tables["correlation_pairs"].collect()}
    assert ("ac_power_lag_7d", "same_hour_last_week") in same
    # a constant feature makes the average undefined, reported as 0
    assert tables["correlation_summary"].first()["average_absolute_correlation"] == 0.0
